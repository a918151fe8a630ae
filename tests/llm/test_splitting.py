"""Pieces against a plain walk from piece to piece."""

import random

from loamstone.llm.splitting import pieces_of, split_oversized


def walk(text, limit, least, overlap):
    out, s = [], 0
    while True:
        if len(text) - s <= limit:
            return out + [(s, len(text))]
        spots = range(min(s + limit, len(text)), s + least - 1, -1)

        def blank(p):
            return text[p - 1] == "\n" and not text[text.rfind("\n", 0, p - 1) + 1 : p - 1].strip(" \t\r")

        tests = [
            blank, lambda p: text[p - 1] == "\n", lambda p: text[p - 1] == " " and p > 1 and text[p - 2] in ".!?",
            lambda p: text[p - 1] == " ",
        ]
        p = next((p for t in tests for p in spots if t(p)), s + limit)
        out.append((s, p))
        s = p - overlap


def test_random_texts():
    rng = random.Random(5)
    for k in range(300):
        kinds = rng.choice(["ab \n.", "abc.", "a \n\t\r", "abcdefgh. ", "a", "é🤷 \n"])
        text = "".join(rng.choice(kinds) for _ in range(rng.randint(41, 900)))
        limit, least, overlap = rng.choice([(40, 20, 5), (40, 40, 39), (25, 10, 0)])
        starts, ends = pieces_of(text, limit, least, overlap)
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == walk(text, limit, least, overlap), (k, text)


def test_cases(spark):
    long = "word " * 900 + "x" * 9000 + "\n\n" + "y. " * 2000
    rows = [(1, None, "a"), (2, "", "b"), (3, "x" * 4000, "c"), (4, "x" * 4001, "d"), (None, long, "e"), (5, long, "f"), (5, long, "g")]
    df = spark.createDataFrame(rows, "raw_id long, content string, piece_no string")
    got = split_oversized(df, "raw_id", "content").collect()
    by = {}
    for r in got:
        by.setdefault(r.raw_id, []).append((r.piece_no, r.start_pos, r.end_pos))
    want = [(i + 1, s, e) for i, (s, e) in enumerate(walk(long, 4000, 2000, 200))]
    assert sorted(by[None]) == want and sorted(by[5]) == sorted(want * 2) and set(by) == {None, 4, 5}
    assert sorted(by[4]) == [(1, 0, 4000), (2, 3800, 4001)]
    assert split_oversized(df.limit(0), "raw_id", "content").count() == 0
