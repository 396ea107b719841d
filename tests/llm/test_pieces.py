import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docprep.llm.pieces import cut_range, split_files, split_texts


def story(seed, n):
    rng = random.Random(seed)
    out = ""
    while len(out) < n:
        out += "".join(rng.choice("abcdefg é漢\U0001f48a") for _ in range(rng.randint(1, 12))) + rng.choice([" ", " ", " ", ". ", "! ", "\n", "\r\n", "\n\n", "。", "\r\n\r\n", "x" * 40])
    return out[:n]


def check(text, spans, limit, overlap):
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    for a, b in spans:
        assert b - a <= limit
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < c <= b < d and b - c <= overlap


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 4000))
def test_pieces_cover_the_text(seed, n):
    text = story(seed, n)
    if len(text) > 200:
        check(text, cut_range(text, 0, len(text), True, True, 200, 20), 200, 20)


def test_cuts_prefer_stronger_boundaries():
    text = "word " * 30 + "\n\n" + "More words. " * 20
    spans = cut_range(text, 0, len(text), True, True, 200, 0)
    assert spans[0][1] == text.index("More") and all(text[b - 2 : b] == ". " for _, b in spans[1:-1])


def test_marks_and_line_ends_stay_together():
    assert cut_range("a" * 99 + "́" + "b" * 99, 0, 199, True, True, 99 + 1, 0)[0][1] in (98, 99, 100)
    text = "a" * 100 + "́" + "b" * 50
    assert cut_range(text, 0, len(text), True, True, 100, 0)[0] == (0, 99)


@pytest.mark.parametrize("blocks", [1, 3, 1000])
def test_split_texts(spark, blocks):
    long = {i: story(i, n) for i, n in enumerate((150, 199, 200, 201, 700, 1000, 1001, 3000, 9000))} | {20: "x" * 5000, 21: " " * 3000, 22: "", 23: None}
    rows = [(i, t, "s", 5) for i, t in long.items()] + [(0, long[0], "s", 5)] + [(30, story(7, 4000), "s", 5)] * 3 + [(31, story(8, 4000), "a", 5), (31, story(9, 4000), "b", 5)]
    df = spark.createDataFrame(rows, "id int, text string, section string, piece_no int")
    out = split_texts(df, "text", ["id"], ("section",), 200, 20, blocks).collect()
    for i, t in long.items():
        mine = sorted({(r.piece_no, r.start, r.end, r.piece, r.section) for r in out if r.id == i})
        if t is None:
            assert not mine
            continue
        assert [r[0] for r in mine] == list(range(len(mine))) and all(t[a:b] == p for _, a, b, p, _ in mine)
        check(t, [(r[1], r[2]) for r in mine], 200, 20) if len(t) > 200 else None
        assert (len(mine) == 1) == (len(t) <= 200)
    assert sum(r.id == 0 for r in out) == 2
    copies = sorted((r.piece_no, r.start, r.end, r.piece) for r in out if r.id == 30)
    assert copies[::3] == copies[1::3] == copies[2::3]
    for section, seed in (("a", 8), ("b", 9)):
        check(story(seed, 4000), sorted((r.start, r.end) for r in out if r.id == 31 and r.section == section), 200, 20)
    same = split_texts(df, "text", ["id"], ("section",), 200, 20, 2).collect()
    assert sorted(map(tuple, same), key=repr) == sorted(map(tuple, out), key=repr)


def test_null_keys_and_empty_table(spark):
    df = spark.createDataFrame([(None, story(1, 5000))], "id int, text string")
    out = split_texts(df, "text", ["id"], (), 200, 20).collect()
    check(story(1, 5000), sorted((r.start, r.end) for r in out), 200, 20)
    assert split_texts(df.limit(0), "text", ["id"]).count() == 0


def test_files_by_byte_ranges(spark, tmp_path):
    texts = {"a.txt": story(5, 60_000), "b.txt": "", "c.txt": "plain words here. " * 3900, "d.txt": "漢" * 20_000, "e.txt": story(6, 12_700), "f.txt": "é"}
    for name, t in texts.items():
        (tmp_path / name).write_bytes(t.encode())
    files = [(str(tmp_path / n), len(t.encode())) for n, t in texts.items()] + [(None, 5), (str(tmp_path / "a.txt"), len(texts["a.txt"].encode()))]
    df = spark.createDataFrame(files, "path string, size bigint")
    found = [sorted(map(tuple, split_files(df, 200, 20, n).collect())) for n in (1, 30_000, 10**9)]
    assert found[0] == found[1] == found[2]
    for name, t in texts.items():
        mine = sorted(r[1:] for r in found[0] if r[0].endswith(name))
        assert [r[0] for r in mine] == list(range(len(mine)))
        raw = t.encode()
        assert all(raw[a:b].decode() == p and t[s : s + len(p)] == p for _, a, b, s, p in mine)
        if t:
            check(t, [(s, s + len(p)) for *_, s, p in mine], 200, 20)
        else:
            assert mine == [(0, 0, 0, 0, "")]
    with pytest.raises(Exception, match="none.txt"):
        split_files(spark.createDataFrame([(str(tmp_path / "none.txt"), 5)], "path string, size bigint"), 200, 20).collect()
    assert split_files(df.limit(0)).count() == 0


def test_bytes_that_are_no_utf8(spark, tmp_path):
    raw = (b"caf\xe9 words. " + "né à\n".encode() + b"\xff\xfe\xf0\x9f ") * 3000
    (tmp_path / "odd.txt").write_bytes(raw)
    df = spark.createDataFrame([(str(tmp_path / "odd.txt"), len(raw))], "path string, size bigint")
    found = [sorted(map(tuple, split_files(df, 200, 20, n).collect())) for n in (1, 10**9)]
    assert found[0] == found[1]
    whole = re.sub("[\udc80-\udcff]", "\ufffd", raw.decode("utf-8", "surrogateescape"))
    assert all(whole[s : s + len(p)] == p for *_, s, p in found[0])
    check(whole, sorted((s, s + len(p)) for *_, s, p in found[0]), 200, 20)


def test_overlap_must_fit():
    from docprep.llm.pieces import _check

    with pytest.raises(ValueError):
        _check(200, 150)


def test_a_piece_overlaps_where_the_cut_is_the_only_strong_boundary():
    text = "word " * 39 + "\n\n" + "More words here. " * 20
    spans = cut_range(text, 0, len(text), True, True, 200, 20)
    end = text.index("More")
    assert spans[0][1] == end and 0 < end - spans[1][0] <= 20 and text[spans[1][0] :].startswith("word ")
