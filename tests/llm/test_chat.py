from textlake.llm import chat

TURNS = "pair_id long, side string, turn int, role string, text string, part string"


def render(turns):
    return "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns)


def test_common_prefix_and_masks(spark):
    shared = [("system", "be brief"), ("user", "hello")]
    good, bad = [("assistant", "Hi!"), ("user", "bye"), ("assistant", "Bye")], [("assistant", "No")]
    rows = [(1, "chosen", i, r, t, "x") for i, (r, t) in enumerate(shared + good)]
    rows += [(1, "rejected", i, r, t, "x") for i, (r, t) in enumerate(shared + bad)]
    rows += [(2, side, 0, "user", "same", "x") for side in ("chosen", "rejected")]
    rows += [(3, "chosen", 0, None, None, "x"), (4, "rejected", 5, "assistant", "<|im_end|>", "x")]
    rows += [(None, "chosen", 0, "user", "lost", "x"), (5, "other", 0, "user", "lost", "x")]
    rows += [(6, side, 0, "user", "twice", "x") for side in ("chosen", "chosen", "rejected")]
    got = {r["pair_id"]: r for r in chat.format_preferences(
        spark.createDataFrame(rows, TURNS)).collect()}
    assert set(got) == {1, 2, 3, 4, 6}
    one = got[1]
    assert (one["prompt"], one["n_prompt_turns"]) == (render(shared), 2)
    assert (one["chosen"], one["rejected"]) == (render(good), render(bad))
    learned = [one["chosen"][s["a"]:s["b"]] for s in one["chosen_spans"]]
    assert learned == ["Hi!<|im_end|>", "Bye<|im_end|>"]
    assert [one["rejected"][s["a"]:s["b"]] for s in one["rejected_spans"]] == ["No<|im_end|>"]
    assert got[2]["prompt"] == render([("user", "same")]) and got[2]["chosen"] == ""
    assert got[3]["chosen"] == render([(None, None)]) and got[3]["prompt"] == ""
    assert got[4]["rejected"] == render([("assistant", "<| im_end|>")])
    assert got[6]["prompt"] == "" and got[6]["chosen"] == render([("user", "twice")] * 2)


def test_queries_pairs(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "first\nsecond"), (1, 2, "user", "thanks"),
            (2, 0, "user", "alone"), (None, 0, "user", "lost")]
    made = chat.shortened_replies(spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string"))
    got = {r["pair_id"]: r for r in chat.format_preferences(made).collect()}
    assert got[1]["chosen"] == render([("assistant", "first\nsecond"), ("user", "thanks")])
    assert got[1]["rejected"] == render([("assistant", "first")])
    assert got[2]["chosen"] == got[2]["rejected"] == ""
    empty = spark.createDataFrame([], TURNS)
    assert chat.format_preferences(empty).count() == 0
