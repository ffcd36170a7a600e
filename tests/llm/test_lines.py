from textlake.llm import lines


def brute(rows):
    """Removed positions by walking the documents in order."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        own = text.split("\n")
        gone = set()
        for i in range(len(own) - 2):
            window = tuple(own[i:i + 3])
            if not "".join(window).strip(" \n\t\r"):
                continue
            if window in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(window)
        out[key] = ("\n".join(line for i, line in enumerate(own) if i not in gone), len(own), len(gone))
    return out


def test_against_walk(spark):
    import random
    random.seed(5)
    rows = [(i, "\n".join(random.choice(["a", "b", "c", "", "d e", " "])
                          for _ in range(random.randint(1, 30)))) for i in range(60)]
    rows = [(k, t) for k, t in rows if t]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"])
           for r in lines.dedup_lines(docs).collect()}
    assert got == brute(rows)


def test_odd_rows(odd_documents, no_documents):
    cleaned = lines.dedup_lines(odd_documents)
    assert cleaned.columns == [*odd_documents.columns, "n_lines", "n_removed"]
    rows = cleaned.collect()
    assert len(rows) == 10
    by_key = {r["doc_id"]: r for r in rows}
    assert by_key[1]["n_removed"] == 0 and by_key[3]["text"] is None
    assert by_key[6]["text"] == "" and by_key[6]["n_removed"] == 4
    assert by_key[None]["n_removed"] == 0
    assert lines.dedup_lines(no_documents).count() == 0
