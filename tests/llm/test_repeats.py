"""The repeated-string operator against a window-by-window count, through every pass."""

import datetime
import decimal
import random

import numpy as np
import pytest
from voxelloom.llm import suffixes


def brute(rows, length=100):
    """(doc_id, text) -> kept bytes; the same row twice is one document."""
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: -(1 << 63) if r[0] is None else r[0]):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            gone[k : k + length] |= data[k : k + length] in seen
            seen.add(data[k : k + length])
        out[i, t] = bytes(b for b, g in zip(data, gone, strict=True) if not g)
    return out


def made(n, seed):
    random.seed(seed)
    words = ["".join(random.choices("abcdeé", k=random.randrange(2, 9))) for _ in range(400)]
    line = " ".join(random.choices(words, k=14))
    passages = [" ".join(random.choices(words, k=40)) for _ in range(4)]
    out = []
    for _ in range(n):
        text = " ".join(random.choices(words, k=random.randrange(0, 60)))
        at = random.randrange(len(text) + 1)
        more = random.choice([line, line[: random.randrange(30, 90)], random.choice(passages), "q" * random.randrange(80, 300), ""])
        out.append(text[:at] + more + text[at:])
    return out + random.sample(out, n // 5)


@pytest.mark.parametrize(("crowd", "gather"), [(20_000, 300_000), (3, 50)])
def test_every_pass_removes_what_a_count_of_windows_does(spark, monkeypatch, crowd, gather):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    monkeypatch.setattr(suffixes, "GATHER", gather)
    rows = [(3 * i, t) for i, t in enumerate(made(120, 5))]
    want = brute(rows)
    got = suffixes.removals(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: bytes(r.kept) for r in got} == {i: want[i, t] for i, t in rows}


def test_equal_hashes_do_not_remove(spark, monkeypatch):
    """With hashes that hold next to nothing, bytes still decide."""
    whole = suffixes.digits

    def dull(texts, length=100, gram=32):
        owner, start, windows, offset, digit, context, place = whole(texts, length, gram)
        return owner, start, windows, offset, digit & np.uint64(0x300), context & np.uint64(1), place

    rows = [(i, t) for i, t in enumerate(made(40, 6))]
    want = brute(rows)
    monkeypatch.setattr(suffixes, "digits", dull)
    got = suffixes.first_digit(suffixes.keyed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), 4, 100, 32)
    assert got.count() > 0
    got = suffixes.removals(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: bytes(r.kept) for r in got} == {i: want[i, t] for i, t in rows}


def test_radix_classes_are_the_equal_strings():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    size = rng.integers(1, 40, 900)
    at = rng.integers(0, 3900, 900)
    rows, classes = suffixes.radix(size, at, data, size)
    strings = [bytes(data[a : a + n]) for a, n in zip(at, size, strict=True)]
    by = {}
    for r, c in zip(rows.tolist(), classes.tolist(), strict=True):
        by.setdefault(c, []).append(r)
    assert all(len({strings[r] for r in group}) == 1 for group in by.values())
    assert sorted(r for g in by.values() for r in g) == [i for i, s in enumerate(strings) if strings.count(s) > 1] and len(by) == len({s for s in strings if strings.count(s) > 1})


def test_other_columns_come_back_as_they_were(spark):
    long = " ".join(f"w{k}" for k in range(80))
    when = datetime.datetime(2020, 1, 2, 3, 4, 5)
    rows = [(when, 1, long, decimal.Decimal("1.50"), b"\x00\xff", {"a": [1, 2]}, None), (None, 2, long + " x", None, None, None, 4.5), (when, None, None, None, b"", {}, float("nan"))]
    df = spark.createDataFrame(rows, "`a.b` timestamp, doc_id int, text string, key decimal(9,2), bucket binary, kind map<string,array<int>>, data double")
    out = suffixes.deduplicated(df.repartition(2))
    assert out.columns == df.columns and [f.dataType for f in out.schema][3:] == [f.dataType for f in df.schema][3:]
    got = sorted(out.collect(), key=lambda r: str(r.doc_id))
    assert got[0]["a.b"] == when and got[0].key == decimal.Decimal("1.50") and got[0].bucket == b"\x00\xff" and got[0].kind == {"a": [1, 2]} and got[0].text == long
    assert got[1].data == 4.5 and got[1]["a.b"] is None and got[1].text == " x" and got[2].text == "" and got[2].data != got[2].data
    assert suffixes.deduplicated(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    random.seed(9)
    text = "".join(random.choices("abcdefgh \n", k=3_000_000))
    rows = [(1, text), (2, "start " + text[1_000_000:1_500_000] + " end"), (3, "z" * 2_000_000)]
    got = {r.doc_id: r for r in suffixes.removals(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert bytes(got[1].kept) == text.encode() and bytes(got[2].kept) == b"start  end" and bytes(got[3].kept) == b"z" and got[3].n_bytes == 2_000_000
