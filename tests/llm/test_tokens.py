"""Token counts, packing and Huffman-coded ids against the tokenizer itself."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

import __spark_entry__ as entry
from cohortline.llm import huffman, packing, unigram
from cohortline.llm.common import shared_path
from cohortline.llm.tokens import UnitEncoder

ODD = [
    "", " ", "  a  b ", " lead", "tail ", "x\n y  z\t\tq", "don't stop's we'll   nb", "café, naïve! 你好 你 Ὠ0 \U0001F600 ok",
    "<|endoftext|> a <|endoftext|>b", "a1b2 3.14, 'tis '' x' 's", "\x1c\x1d a \x85 b", "a b 　c", "é café x",
    "_a_ __ -- a-b- (x) [y]. \"q\"", "Łódź. ªº ʰa ǅ", "a\nb", "\na b\n", "a.\nB c\n\nd e,\n\tf\r\ng h i", "it\n's don\n't", "%%% !!! a%%% b!!"]


def ids_by_tokenizer(bpe, texts):
    tokenizer = Tokenizer.from_str(bpe.decode())
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_units_give_the_tokenizers_ids(bpe):
    encoder = UnitEncoder(bpe)
    for _ in range(2):  # cold and cached
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_all(ODD)] == ids_by_tokenizer(bpe, ODD)


def test_other_tokenizers_read_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = UnitEncoder(open(path, "rb").read()), Tokenizer.from_file(path)
    assert not encoder.by_unit
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_all(ODD)] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]


@pytest.fixture(scope="module")
def unigram_tokenizer():
    pieces = unigram.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    tokenizer = Tokenizer(models.Unigram(pieces, 0, True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace()
    return pieces, tokenizer


def test_counts_equal_the_unigram_tokenizer(spark, sf_dir, unigram_tokenizer):
    _, tokenizer = unigram_tokenizer
    want = {r["doc_id"]: len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in entry.queries()["op1_token_counts"](spark, sf_dir).collect()} == want


def test_counts_of_odd_texts_and_ties(documents, odd_rows, unigram_tokenizer):
    pieces, tokenizer = unigram_tokenizer
    got = unigram.count_tokens(documents(odd_rows), pieces).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted(
        (str(i), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in odd_rows)
    assert unigram.count_tokens(documents([]), pieces).collect() == []
    tied = [("<unk>", -9.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("▁ab", -3.0), ("bb", -2.0), ("<0x63>", -5.0)]
    tie = Tokenizer(models.Unigram(tied, 0, True))
    tie.pre_tokenizer = pre_tokenizers.Metaspace()
    counter = unigram.PieceCounter(tied)
    for text in ("ab abb bbb", "aabbab", "abc", "c ab", "ccc", "  ab  "):
        assert counter.count(text) == len(tie.encode(text, add_special_tokens=False).ids), text


def assert_packed(rows, ids, capacity=1024):
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert len(part) == r["length"] > 0 and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans, total in [(pieces[i], len(ids[i])) for i in ids] + [(w, None) for w in windows.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == total if total is not None else at <= capacity
    return sum(capacity - sum(n for _, n in w) for w in windows.values()), len(windows)


def test_packing_of_documents(spark, sf_dir, bpe):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    ids = {i: found + [0] for (i, _), found in zip(docs, ids_by_tokenizer(bpe, [t for _, t in docs]))}
    padding, sequences = assert_packed(entry.queries()["op3_packing"](spark, sf_dir).collect(), ids)
    assert padding <= 1024 + 4 * sequences


def test_packing_of_odd_and_equal_lengths(documents, odd_rows, bpe):
    rows = [(n, t) for n, (_, t) in enumerate(odd_rows)] + [(100 + n, "a b c " * 250) for n in range(60)]
    ids = {i: found + [0] for (i, _), found in zip(rows, ids_by_tokenizer(bpe, [t for _, t in rows]))}
    got = packing.pack(documents(rows), bpe)
    padding, sequences = assert_packed(got.collect(), ids)
    assert padding <= 1024 + 4 * sequences  # the hot length is cut, not padded
    assert packing.pack(documents(odd_rows), bpe).count() >= len(odd_rows)
    assert packing.pack(documents([]), bpe).collect() == []


def test_windows_come_closest_to_the_capacity():
    assert packing.fill_window({7: 1, 4: 2, 3: 1, 2: 5}, 10) == {7: 1, 3: 1}
    patterns, left = packing.plan_windows({6: 3, 4: 2, 5: 2}, 10, 0)
    assert sorted(patterns, key=str) == [({5: 2}, 1), ({6: 1, 4: 1}, 2)] and left == {6: 1}


def test_huffman_codes_are_optimal_and_bounded():
    rng = np.random.default_rng(3)
    counts = (rng.pareto(0.4, 300) * 5).astype(np.int64).clip(0, 10**9)
    free, bounded = huffman.code_lengths(counts, 40), huffman.code_lengths(counts, 9)
    used = counts > 0
    assert bounded.max() <= 9 and abs(sum(2.0 ** -bounded[used].astype(float)) - 1) < 1e-12
    import heapq
    heap, total = [int(c) for c in counts[used]], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    assert int((free * counts).sum()) == total <= int((bounded * counts).sum())
    ids = rng.choice(np.flatnonzero(used), 5_000)
    for lengths in (free, bounded):
        book = huffman.Codebook(lengths)
        doc_ids, sizes, back = huffman.read_block(book, huffman.write_block(book, [5, None], [4_000, 1_000], ids, 64))
        assert doc_ids == [5, None] and sizes.tolist() == [4_000, 1_000] and np.array_equal(back, ids)
    single = huffman.Codebook(huffman.code_lengths(np.array([0, 7])))
    assert huffman.read_block(single, huffman.write_block(single, [1], [3], np.array([1, 1, 1])))[2].tolist() == [1, 1, 1]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5, np.int64), 2)


def test_ids_round_trip(spark, documents, odd_rows, bpe, sf_dir):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    want, start = {}, 0
    for (i, _), found in zip(docs, ids_by_tokenizer(bpe, [t for _, t in docs])):
        data = np.array(found + [2], "<u4")
        want[i] = (start, len(data), zlib.crc32(data.tobytes()))
        start += len(data)
    got = entry.queries()["op6_huffman_ids"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want
    path = shared_path(spark, "odd-ids")
    huffman.write_ids(documents(odd_rows), path, bpe)
    rows = sorted(huffman.read_ids(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, *sorted(i for i, _ in odd_rows if i is not None)]
    assert rows[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
    tokens = {str(i): found + [2] for (i, _), found in zip(odd_rows, ids_by_tokenizer(bpe, [t for _, t in odd_rows]))}
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == tokens[str(r["doc_id"])] for r in rows)
    assert huffman.encode_and_read(documents([]), bpe).collect() == []


def test_rows_of_one_id_spread_and_stay_in_order(spark, documents, bpe, tmp_path):
    rows = [(None, f"free text {i}") for i in range(40)] + [(3, f"other text {i} " * (i % 5)) for i in range(60)] + [(9, "x")]
    path = str(tmp_path / "hot")
    huffman.write_ids(documents(rows), path, bpe, partitions=6)
    back = sorted(huffman.read_ids(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in back] == [None] * 40 + [3] * 60 + [9]
    assert [r["start"] for r in back] == np.cumsum([0, *[r["n_tokens"] for r in back]])[:-1].tolist()
    assert spark.read.parquet(f"{path}/blocks").select("part").distinct().count() > 2
    again = str(tmp_path / "again")
    huffman.write_ids(documents(rows[::-1]), again, bpe, partitions=2)
    key = [(r["start"], r["ids_crc32"]) for r in back]
    assert sorted((r["start"], r["ids_crc32"]) for r in huffman.read_ids(spark, again).collect()) == key


def test_codes_follow_the_number_of_symbols():
    counts = np.ones(70_000, dtype=np.int64)
    lengths = huffman.code_lengths(counts, 17)
    book = huffman.Codebook(lengths)
    ids = np.arange(0, 70_000, 7, dtype="<u4")
    at, bits = book.encode(ids)
    assert lengths.max() == 17 and book.decode(bits, at[::256], len(ids), 256).tolist() == ids.tolist()
