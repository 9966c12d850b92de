"""Fill-in-middle: cuts by brute force, forms and restoring, odd tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from questmart.llm import infill

SCHEMA = "doc_id long, text string, n string, form long, h1 string, output string"
ALPHABET = "ab é日😀\n \t."


def units_of(text, unit):
    if unit == "word":
        return re.findall(r"[^\x20\x09-\x0d]+[\x20\x09-\x0d]*", text)
    return list(text) if unit == "char" else text.split("\n")[:-1]


def place(text, units, count, unit):
    """Bytes before the cut behind ``count`` units."""
    if count == 0:
        return 0
    if unit == "line":
        return len(("\n".join(units[:count]) + "\n").encode())
    if count == len(units):
        return len(text.encode())
    in_front = re.match(r"[\x20\x09-\x0d]*", text)[0] if unit == "word" else ""
    return len((in_front + "".join(units[:count])).encode())


@pytest.mark.parametrize("unit", list(infill.UNITS))
def test_cuts_against_brute_force(unit):
    rng = random.Random(1)
    texts = ["", "a", "é\n 日本 x", "", "  two  words\nnext line\n", "\n", " "] + ["".join(rng.choices(ALPHABET, k=rng.randrange(300))) for _ in range(150)]
    coded = [t.encode() for t in texts]
    draws = np.array([[rng.randrange(2**32), rng.randrange(2**32)] for _ in texts])
    offsets = np.r_[0, np.cumsum([len(c) for c in coded])]
    n, sizes, first, second = infill.cut_texts(np.frombuffer(b"".join(coded), np.uint8), offsets, draws, unit)
    for i, text in enumerate(texts):
        units = units_of(text, unit)
        a, b = sorted(int(d) % (len(units) + 1) for d in draws[i])
        assert n[i] == len(units) and (sizes[0][i], sizes[1][i]) == (a, b - a)
        assert first[i] - offsets[i] == place(text, units, a, unit) and second[i] - offsets[i] == place(text, units, b, unit)


@pytest.mark.parametrize("unit", list(infill.UNITS))
def test_last_text_is_cut_at_its_end(unit):
    """the last search ended one behind the texts, and asked on there while others were open; at 63 bytes modulo 64 no word has that bit."""
    for length in range(60, 132):
        for last in ("", "a", "é b\n"):
            texts = ["x y\n" * 40, last]
            texts[0] = texts[0][: length - len(last.encode())]
            coded = [t.encode() for t in texts]
            n = [len(units_of(t, unit)) for t in texts]
            draws = np.array([[1, n[0] // 2], [n[1], n[1]]])
            offsets = np.r_[0, np.cumsum([len(c) for c in coded])]
            units, sizes, first, second = infill.cut_texts(np.frombuffer(b"".join(coded), np.uint8), offsets, draws, unit)
            assert offsets[-1] == length and units.tolist() == n
            for i, text in enumerate(texts):
                a, b = sorted(int(d) % (n[i] + 1) for d in draws[i])
                assert (sizes[0][i], sizes[1][i]) == (a, b - a)
                assert first[i] - offsets[i] == place(text, units_of(text, unit), a, unit)
                assert second[i] - offsets[i] == place(text, units_of(text, unit), b, unit)


def test_text_of_63_bytes_before_an_empty_one(spark):
    """F1, as a query: an empty text is always cut at its end."""
    docs = spark.createDataFrame([(1, "x" * 63), (2, None)], "doc_id long, text string").coalesce(1)
    rows = infill.fill_in_middle(docs).withColumn("restored", infill.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((r.doc_id, r.n, r.restored) for r in rows) == [(1, 63, "x" * 63), (2, 0, "")]


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(3)
    for length in (0, 1, 63, 64, 65, 1000):
        classes = rng.integers(0, 5, length).astype(np.uint8)
        matrix, at = infill.WaveletMatrix(classes), np.arange(length + 1)
        for symbol in range(5):
            assert matrix.rank(symbol, at).tolist() == np.r_[0, np.cumsum(classes == symbol)].tolist()


@pytest.mark.parametrize("unit", list(infill.UNITS))
def test_texts_come_back_in_every_form(spark, unit):
    rng = random.Random(2)
    texts = ["".join(rng.choices(ALPHABET + "<>PSM", k=rng.randrange(60))) for _ in range(300)] + ["<P>", "x<S", "<S", "a <M> b", ">", "<"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = infill.fill_in_middle(docs, unit=unit).withColumn("restored", infill.restored(F.col("output"), F.col("form"))).collect()
    assert {r.form for r in rows} == {infill.PLAIN, infill.PSM, infill.SPM}
    for r in rows:
        text, out = texts[r.doc_id], bytes(r.output).decode()
        assert r.restored == text
        if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
            assert r.form == infill.PLAIN
        assert (r.prefix_units is None) == (r.form == infill.PLAIN) and (out == text) == (r.form == infill.PLAIN)
        if r.form != infill.PLAIN:
            assert out.startswith("<P>" if r.form == infill.PSM else "<S>") and len(out) == len(text) + 9


def test_odd_tables(spark):
    long = "long é text\n" * 200_000
    given = [(1, "same"), (1, "same"), (2, None), (3, ""), (None, "no id"), (None, None), (4, long), (5, "😀\u0000中文 \t")]
    docs = spark.createDataFrame([(d, t, "n", 1, "h", "o") for d, t in given], SCHEMA)
    rows = infill.fill_in_middle(docs, plain_from=100).withColumn("restored", infill.restored(F.col("output"), F.col("form"))).collect()
    got = sorted((r.doc_id or 0, r.restored, r.n) for r in rows)
    assert got == sorted((d or 0, t or "", len(t or "")) for d, t in given)
    assert all((r.form == infill.PLAIN) == (r.n == 0) for r in rows)
    assert infill.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        infill.fill_in_middle(docs, unit="page")
