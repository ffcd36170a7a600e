import hashlib
import random
import re
import sys

import pytest

from textlake.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text)
               if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text)
                 if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15],
    }


def test_base_equals_patterns():
    random.seed(7)
    for letters in ("a1.@-+ b", "0123456789 -.", "+(1) 23-.4", "4 -0", "a@b.c@"):
        for _ in range(3000):
            text = "".join(random.choice(letters) for _ in range(random.randint(0, 60)))
            assert pii.base_spans(text) == plain(text), text


def test_card():
    text = "no 4041894974608795 and 4041 8949 7460 8795, not 4041894974608796"
    assert pii.base_spans(text) == plain(text)
    assert len(pii.base_spans(text)["card"]) == 2


@pytest.mark.parametrize("text, kind, value", [
    ("write to jo.doe [at] mail [dot] example (dot) com now", "email",
     "jo.doe [at] mail [dot] example (dot) com"),
    ("write to jane at example dot org today", "email", "jane at example dot org"),
    ("jоhn@exаmple.com".replace("x", "x"), "email", "jоhn@exаmple.com"),
    ("call plus four nine three zero one two three four five six now", "phone",
     "plus four nine three zero one two three four five six"),
    ("ip １９２.168.0.１ here", "ip", "１９２.168.0.１"),
    ("see jo​e@exam​ple.com", "email", "jo​e@exam​ple.com"),
    ("ip one nine two dot one six eight".replace("dot one six eight", ".168.0.1"), "ip",
     "one nine two .168.0.1"),
])
def test_disguises(text, kind, value):
    base, added = pii.find_all(text)
    found = [text[a:b] for a, b in base[kind] + added[kind]]
    assert value in found


@pytest.mark.parametrize("text, kind, plain_part, value", [
    ("to j\u043ehn@example.com now", "email", "hn@example.com", "j\u043ehn@example.com"),
    ("ip 192.168.0.1\uff12 here", "ip", "192.168.0.1", "192.168.0.1\uff12"),
    ("call +49 30 1234\uff15\uff1667 now", "phone", "+49 30 1234", "+49 30 1234\uff15\uff1667"),
])
def test_partly_disguised_is_added_whole(text, kind, plain_part, value):
    base, added = pii.find_all(text)
    assert [text[a:b] for a, b in base[kind]] == [plain_part]
    assert [text[a:b] for a, b in added[kind]] == [value]


def test_equal_or_inner_spans_are_not_added():
    text = "a\u00adb c@example.com and 10.0.0.1"
    base, added = pii.find_all(text)
    assert len(base["email"]) == len(base["ip"]) == 1 and not any(added.values())


@pytest.mark.parametrize("text, kind, value", [
    ("to \U0001d41co@example.com", "email", "\U0001d41co@example.com"),
    ("to \u24d0nn@example.com", "email", "\u24d0nn@example.com"),
    ("to ann\ufe6bexample\ufe52com", "email", "ann\ufe6bexample\ufe52com"),
    ("ip \u09e7\u09e6.0.0.1 here", "ip", "\u09e7\u09e6.0.0.1"),
    ("ip \u0e51\u0e50.0.0.\u2780 here", "ip", "\u0e51\u0e50.0.0.\u2780"),
    ("john@example .com", "email", "john@example .com"),
    ("+four nine 17612345678", "phone", "+four nine 17612345678"),
])
def test_signs_are_seen_in_any_form(text, kind, value):
    base, added = pii.find_all(text)
    assert value in [text[a:b] for a, b in added[kind]]


@pytest.mark.parametrize("text, kind, value", [
    *((f"an ana at correo dot {end} bitte", "email", f"ana at correo dot {end}")
      for end in "pt jp se pl ru br cl pe online museum".split()),
    ("to ana at mail dot firma dot zebra now", "email", "ana at mail dot firma dot zebra"),
    ("to ana at mail [dot] zebra now", "email", "ana at mail [dot] zebra"),
    ("to ana at correo dot com dot and so", "email", "ana at correo dot com"),
    ("ip 192 dot 168 dot 0 dot 1 here", "ip", "192 dot 168 dot 0 dot 1"),
    ("ip one nine two dot one six eight dot zero dot one here", "ip",
     "one nine two dot one six eight dot zero dot one"),
    ("ip 10 point zéro point 0.1 ici", "ip", "10 point zéro point 0.1"),
])
def test_written_at_and_dot(text, kind, value):
    base, added = pii.find_all(text)
    assert value in [text[a:b] for a, b in added[kind]]


def test_dots_in_prose_stay_clean():
    for text in ("look at this dot in it", "aim at red dot on paper", "he came at one point we saw",
                 "versions 3 dot 5 dot 1", "laugh at every point of it", "at some point he left"):
        base, added = pii.find_all(text)
        assert not any(base.values()) and not any(added.values()), text


def test_sign_characters_are_what_is_undone():
    for char in map(chr, range(0x80, sys.maxunicode + 1)):
        assert bool(pii._SIGN_CHARS.match(char)) == (pii.plain_form(char) != char), hex(ord(char))


def test_cheap_tests_pass_over_nothing(monkeypatch):
    random.seed(11)
    parts = [*pii.SPELLED, "FİVE", *pii.DOT_WORDS.split("|"), *pii.AT_WORDS.split("|"), "[at]", "( dot )", "<.>",
             "a", "bo", "example", "com", "org", "@", ".", ".", "+", "-", ",", "1", "192", "49",
             "\u00a0", "\u2003", "\n", "\u0967", "\U0001d41a", "\u043e", "\u00ad", "é", "17612345678"]
    texts = ["".join(random.choice(parts) + random.choice(["", " ", " "])
                     for _ in range(random.randint(1, 14))) for _ in range(20_000)]
    gated = [pii.find_all(text) for text in texts]
    monkeypatch.setattr(pii, "shows_signs", lambda text: True)
    for text, found in zip(texts, gated):
        assert pii.find_all(text) == found, text


def test_plain_prose_stays_clean():
    for text in ("Meet me at noon. Dot your i at home.", "un deux trois", "one or two, three times",
                 "Deux et un font trois.", "look at the dot on the wall"):
        base, added = pii.find_all(text)
        assert not any(base.values()) and not any(added.values()), text


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 100_000, "a@" * 100_000,
                 "at " * 100_000, "one " * 50_000, "[at] " * 50_000):
        pii.find_all(text)


def test_tables(odd_documents, no_documents):
    rows = pii.pii_report(odd_documents).collect()
    assert len(rows) == 10 and all(r["n_email"] == 0 for r in rows)
    assert pii.find_pii(odd_documents).columns == [*odd_documents.columns, "pii"]
    assert pii.find_pii(odd_documents).count() == 10
    assert pii.pii_report(no_documents).count() == 0


@pytest.mark.parametrize("text, kind, value", [
    ("to pαul@example.com now", "email", "pαul@example.com"),
    ("to мaria@example.com now", "email", "мaria@example.com"),
    ("to каte@example.com now", "email", "каte@example.com"),
    ("write john dot doe at example dot com now", "email", "john dot doe at example dot com"),
    ("to j dot r dot doe@example .com now", "email", "j dot r dot doe@example .com"),
    ("call +49 176 one 2345678 now", "phone", "+49 176 one 2345678"),
    ("call +one 49 176 2345678 now", "phone", "+one 49 176 2345678"),
    ("ip 192 . 168 . 0 . 1 here", "ip", "192 . 168 . 0 . 1"),
    ("ann at aa dot bb dot cc dot dd dot ee dot ff dot com ok", "email",
     "ann at aa dot bb dot cc dot dd dot ee dot ff dot com"),
    ("n" * 90 + " at example dot com ok", "email", "n" * 90 + " at example dot com"),
    ("a@b" + " dot b" * 40 + ", ok", "email", "a@b" + " dot b" * 40),
    ("ann at mail dot com dot b2 ok", "email", "ann at mail dot com"),
])
def test_long_and_mixed_disguises(text, kind, value):
    base, added = pii.find_all(text)
    assert value in [text[a:b] for a, b in added[kind]]


@pytest.mark.parametrize("char", sorted(pii.LOOK_ALIKES))
def test_every_look_alike_in_every_position(char):
    for address in (f"{char}b@exa.com", f"a{char}b@exa.com", f"ab{char}@exa.com",
                    f"ab@{char}xa.com", f"ab@ex{char}.com", f"ab@exa.c{char}m", f"ab@exa.co{char}"):
        base, added = pii.find_all(f"to {address} now")
        assert [f"to {address} now"[a:b] for a, b in added["email"]] == [address]


def test_words_near_numbers_stay_clean():
    for text in ("I paid one 4041894974608795 today", "pages 1. 2. 3. 4 of it", "the one . two of us",
                 "this dot at the door", "call one or two men", "room 12, two 5 and 7"):
        base, added = pii.find_all(text)
        assert base == plain(text) and not any(added.values()), text
    base, added = pii.find_all("the end of this point ann at example dot com")
    assert ["ann at example dot com"] == [
        "the end of this point ann at example dot com"[a:b] for a, b in added["email"]]


def test_long_written_chains_are_linear():
    for text in ("a dot " * 100_000 + "a at b dot com", "a at b" + " dot b" * 100_000,
                 "a at b" + " dot b1" * 100_000, "a@b" + " . b" * 100_000, "1 . " * 100_000,
                 "1 one " * 100_000, "at dot " * 100_000):
        pii.find_all(text)


def test_report_values(spark, odd_documents):
    texts = {1: "jo [at] exa dot com, +49 30 1234567", 2: None, 3: "", 4: "192 . 168 . 0 . 1"}
    rows = spark.createDataFrame([*texts.items(), (None, texts[1])], "doc_id long, text string")
    for row in pii.pii_report(rows).collect():
        base, added = pii.find_all(texts[row["doc_id"] or 1])
        listed = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k])
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["spans"] == ",".join(
            f"{k}:{a}:{b}" for k in pii.KINDS for a, b in sorted(base[k] + added[k]))
        assert [row[f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]
