"""Whitening, resampling and byte-level BPE against plain versions."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cohortline.llm import bytebpe, common, resample, whitening
from cohortline.llm.driver_queries import QUERIES


# -- whitening -------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, n long, x string, component int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], VECTORS)


def check_whitening(rows, found, components=32):
    """``found``: rows of the operator, ``rows``: the usable (id, vector) pairs."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    exact = n * x - sums[None, :]
    centred = exact.astype(float) / n
    values, _ = np.linalg.eigh(centred.T @ centred / n)
    values = values[::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    deviations = Counter((i, int(d)) for (i, _), d in zip(rows, (exact ** 2).sum(axis=1)))
    assert Counter((r["vec_id"], r["deviation"]) for r in found if r["component"] == 1) == deviations
    assert {r["component"] for r in found} == set(range(1, k + 1)) and len(found) == n * k
    assert all(r["n"] == n and r["identity_error"] < 1e-8 for r in found)
    for j in range(k):
        assert all(abs(r["explained"] - values[j] / values.sum()) < 1e-9 for r in found if r["component"] == j + 1)
    return centred, values[:k]


def test_whitening_of_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    found = QUERIES["op11_whitening"](spark, sf_dir).collect()
    centred, values = check_whitening([(r["vec_id"], r["embedding"]) for r in table], found)
    white = np.zeros((len(table), len(values)))
    place = {r["vec_id"]: i for i, r in enumerate(table)}
    for r in found:
        white[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    # each column is a projection on a unit eigenvector of the covariance
    directions = np.linalg.lstsq(centred, white * np.sqrt(values), rcond=None)[0]
    assert np.abs(directions.T @ directions - np.eye(len(values))).max() < 1e-10
    covariance = centred.T @ centred / len(centred)
    assert np.abs(covariance @ directions - directions * values).max() < 1e-9 * values[0]


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.normal(size=4) * [1, 2, 0.1, 5]]) for i in range(60)]
    good += [(7, good[7][1])] * 30 + [(None, [1.0, 2.0, 3.0, 4.0])]
    bad = [(200, None), (201, [1.0, None, 2.0, 3.0]), (202, [float("nan"), 1.0, 1.0, 1.0]), (203, [float("inf"), 1.0, 1.0, 1.0]),
           (204, []), (205, [1.0, 2.0]), (206, [1e30, 0.0, 0.0, 0.0])]
    check_whitening(good, whitening.whitened_rows(vectors(spark, good + bad)).collect())


def test_whitening_without_variance(spark):
    rng = np.random.default_rng(4)
    flat = [(i, [float(a), 1.0, float(b), float(a) * 2]) for i, (a, b) in enumerate(rng.integers(-20, 20, size=(50, 2)))]
    found = whitening.whitened_rows(vectors(spark, flat)).collect()  # a constant and a doubled dimension
    check_whitening(flat, found)
    assert {r["component"] for r in found} == {1, 2}
    assert whitening.whitened_rows(vectors(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    assert whitening.whitened_rows(vectors(spark, [(1, None)])).collect() == []
    assert whitening.whitened_rows(vectors(spark, [])).columns[0] == "vec_id"


def test_whitening_of_ill_conditioned_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 3)) * [1000, 1000, 0.1]
    rows = [(i, [float(a), float(a + b * 0.001), float(c)]) for i, (a, b, c) in enumerate(base)]
    check_whitening(rows, whitening.whitened_rows(vectors(spark, rows)).collect())


def test_deviations_beyond_a_long():
    x = np.array([[10 ** 9, 0], [0, 0]], dtype=np.int64)
    assert whitening._deviations(x, 3, np.array([0, 0])).to_pylist() == [9 * 10 ** 18, 0]
    assert whitening._deviations(x, 4, np.array([0, 0])).to_pylist() == [None, 0]


def test_sums_in_levels(spark):
    parts = spark.range(0, 300, 1, 300).selectExpr("cast(id as int) as part").collect()
    rows = [(r["part"], np.array([r["part"], 1], "<i8").tobytes()) for r in parts]
    df = spark.createDataFrame(rows, "part int, data binary")
    assert common.sum_arrays(df, 300, "<i8", fan_in=4).tolist() == [300 * 299 // 2, 300]
    assert common.sum_arrays(df.limit(0), 300, "<i8") is None


# -- resampling ------------------------------------------------------------------------------------------------

def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def plain_resample(docs, target, max_n=1, buckets=10_000, percent=10, min_words=20):
    def found(text):
        words = plain_words(text)
        grams = [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]

    sides = [(i, *found(t)) for i, t in docs]
    s = Counter(b for _, _, grams in sides for b in grams)
    t = Counter(b for text in target for b in found(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    rows = []
    for i, n, grams in sides:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in grams)
        rows.append((i, n, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = {id(r): k for k, r in enumerate(eligible[:len(eligible) * percent // 100], 1)}
    return Counter((r[0], r[2], r[3], r[4], rank.get(id(r))) for r in rows)


@pytest.mark.parametrize("max_n, percent, buckets", [(1, 10, 10_000), (2, 50, 70_000), (3, 100, 64)])
def test_resampling_equals_the_plain_version(spark, documents, odd_rows, max_n, percent, buckets):
    rng = np.random.default_rng(1)
    texts = [(100 + i, " ".join(f"Word{w} é{w}!" for w in rng.integers(0, 40, size=rng.integers(0, 60)))) for i in range(80)]
    rows = [(i, t) for i, t in odd_rows] + texts
    target = [t for _, t in texts[:9]] + [None, ""]
    made = resample.resample(
        documents(rows), spark.createDataFrame([(1, t, "w") for t in target], "item_id int, text string, weight string"),
        max_n=max_n, percent=percent, buckets=buckets, min_words=5)
    assert Counter(tuple(r) for r in made.collect()) == plain_resample(rows, target, max_n, buckets, percent, 5)


def test_resampling_ties_and_empty_tables(spark, documents):
    same = [(5, "a b c d e " * 5)] * 40
    target = spark.createDataFrame([(1, None)], "item_id int, text string")
    ranks = [r["rank"] for r in resample.resample(documents(same), target).collect()]
    assert sorted(r for r in ranks if r) == [1, 2, 3, 4] and ranks.count(None) == 36
    assert resample.resample(documents([]), target).collect() == []
    assert [tuple(r)[:3] for r in resample.resample(documents([(1, None)]), target.limit(0)).collect()] == [(1, 0, 0)]


def test_overlapping_spans():
    assert [m.span() for m in resample.ngram_pattern(2).finditer(b"ab c de", overlapped=True)] == [(0, 4), (3, 7)]
    assert resample.collapse("A-b\u00e9\u2003C1\t\n") == "a b\u00e9\u2003c1".encode()


# -- byte-level BPE --------------------------------------------------------------------------------------------

@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def ranks(request):
    with open(public_tokenizers.path(request.param), "rb") as file:
        return bytebpe.read_ranks(file.read())


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("cut_at_spaces", [False, True])
def test_ids_equal_the_library_and_decode(spark, documents, odd_rows, ranks, cut_at_spaces):
    rng = np.random.default_rng(2)
    letters = "".join(rng.choice(list("abcdefghijklmnop"), size=5000))
    han = "".join(chr(c) for c in rng.integers(0x4E00, 0x5200, size=4000))
    rows = odd_rows + [(50, letters), (51, han), (52, " " * 700 + "x" + "\n" * 300), (53, "=" * 999 + "\x00\x7f ‍"), (54, "'s'S don't we'LL 12345678 ½")]
    rows += [(60 + i, "".join(rng.choice(list("ab' 1.\n\t\x1c\x1f\x00é"), size=200))) for i in range(40)]
    rows += [(100 + i, t) for i, t in enumerate((" a", "a ", "\na\nb ", "a\x00 b", " ", "\n", "a\n b", "a \nb", "a b\u00a0 c"))]
    coded = bytebpe.decode(bytebpe.encode(documents(rows), ranks, public_tokenizers.PATTERN, cut_at_spaces), ranks).collect()
    encoding = library(ranks)
    expected = Counter((i, tuple(encoding.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in coded) == expected


def test_query_equals_the_library(spark, sf_dir):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        encoding = library({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})
    expected = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        expected.add((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                      hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op13_byte_bpe"](spark, sf_dir).collect()} == expected


def test_long_rows_merge_as_matrices_do(ranks):
    table = bytebpe.PairTable(*bytebpe.PairTable.arrays(ranks))
    rng = np.random.default_rng(6)
    for alphabet in ("a", "ab", "aab", "abcde ", "etaoin shrdlu"):
        data = "".join(rng.choice(list(alphabet), size=600)).encode()
        tokens = table.byte_ids[np.frombuffer(data, np.uint8)]
        assert bytebpe.merge_long(tokens, table).tolist() == [t for t in bytebpe.merge_rows(tokens[None, :].copy(), table)[0] if t != bytebpe.NONE]


def test_texts_beyond_a_group(ranks):
    encoder = bytebpe.Encoder(bytebpe.PairTable(*bytebpe.PairTable.arrays(ranks)), public_tokenizers.PATTERN)
    text = " ".join(f"word{i % 1313} it's" for i in range(120_000))
    assert len(text) > bytebpe.GROUP_CHARS
    found = list(encoder.encode_all([None, "a b", text, "", "z" * 300_000]))
    expected = [library(ranks).encode_ordinary(t) for t in ("", "a b", text, "")]
    assert [np.frombuffer(f, "<u4").tolist() for f in found[:4]] == expected
    assert sum(len(k) for k in [*encoder.pieces, *encoder.units] if len(k) > bytebpe.MAX_CACHED_CHARS) == 0


def test_small_vocabularies():
    bytes_only = {bytes([b]): 255 - b for b in range(256)}
    ranks = {**bytes_only, b"ab": 256, b"abc": 257, b"bc": 300}
    table = bytebpe.PairTable(*bytebpe.PairTable.arrays(ranks))
    assert bytebpe.PairTable.arrays({**bytes_only, b"abc": 256, b"ab": 257})[3].tolist() == [257]
    encoder = bytebpe.Encoder(table, r"\S+|\s+")
    assert np.frombuffer(next(encoder.encode_all(["abcbc"])), "<u4").tolist() == [257, 300]
    plain = bytebpe.Encoder(bytebpe.PairTable(*bytebpe.PairTable.arrays(bytes_only)), r"\S+|\s+")
    assert np.frombuffer(next(plain.encode_all(["a b"])), "<u4").tolist() == [158, 223, 157]
    with pytest.raises(ValueError, match="no token"):
        bytebpe.PairTable.arrays({b"a": 0})


def test_tokens_that_merge_at_once_at_a_lower_rank():
    """``ba`` is learned late, but ``ba`` + ``b`` makes a token of lower rank, which takes the ``b`` of the next pair."""
    ranks = {**{bytes([b]): b for b in range(256)}, b"bab": 256, b"ba": 257}
    table = bytebpe.PairTable(*bytebpe.PairTable.arrays(ranks))
    rng = np.random.default_rng(8)
    for size in (5, 50, 400):
        tokens = table.byte_ids[np.frombuffer(bytes(rng.choice(list(b"ab"), size=size).tolist()), np.uint8)]
        assert bytebpe.merge_long(tokens, table).tolist() == [t for t in bytebpe.merge_rows(tokens[None, :].copy(), table)[0] if t != bytebpe.NONE]
