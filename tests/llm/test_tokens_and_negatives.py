"""Alignment, cached token counts and hard negatives against the libraries and plain loops, and on odd rows."""

import collections
import hashlib
import math
import subprocess
import sys
import tempfile
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import alignment, chunks, negatives, token_counts

SMALL = "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "  ", "a  b", "a \n b\t \n  c  ", " lead", "trail ", "x  y", "a<|endoftext|>b", " " * 1000, "　 　",
    "it's 's ' s", "a​ b", "é \U0001f600 ", "\x1c \x1c x", "x ▁y z", "<0x41> <s> </s>", "é \x00b", "wort " * 20_000,
]
TEXT = st.text(st.one_of(st.sampled_from("aeth nio.,'s=-0123\n\t  ▁　"), st.characters(exclude_categories=["Cs"])), max_size=50)


@pytest.fixture(scope="module")
def libraries():
    plain = Tokenizer.from_file(BYTES)
    plain.encode_special_tokens = True
    return plain, sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**7 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    return docs.union(odd).repartition(3).cache()


def contents(path):
    with open(path, "rb") as file:
        return file.read()


def plain_alignment(libraries, text):
    """Tokens, links and the group text of the contract, by loops over offsets."""
    a, b = (libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)) if text else ([], [])
    of = alignment.byte_level()
    names = {i: t for t, i in libraries[0].get_vocab(False).items()}
    bytes_a = [bytes(of[c] for c in names[i]) for i in a]
    bytes_b = [bytes([int(p[3:5], 16)]) if libraries[1].is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, libraries[1].id_to_piece(i)) for i in b)]
    if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return 0, 0, [], ""
    ends = [dict(zip(np.cumsum(list(map(len, x))).tolist(), ids, strict=True)) for x, ids in ((bytes_a, a), (bytes_b, b))]
    both = sorted(set(ends[0]) & set(ends[1]))
    groups, last = [], 0
    for end in both:
        groups.append("|".join(",".join(str(i) for e, i in side.items() if last < e <= end) for side in ends))
        last = end
    return len(a), len(b), [(ends[0][e], ends[1][e]) for e in both], ";".join(groups)


def test_alignment_against_plain_loops(spark, libraries, texts):
    got = {r.doc_id: r for r in alignment.align_texts(texts, BYTES, PIECES).collect()}
    want = {r.doc_id: plain_alignment(libraries, r.text or "") for r in texts.where("length(text) < 5000 or text is null").collect()}
    long = {r.doc_id: r.text for r in texts.where("length(text) >= 5000").collect()}
    for key, text in long.items():
        a, b = libraries[0].encode(" " + text, add_special_tokens=False), libraries[1].encode(text)
        assert (got[key].n_a, got[key].n_b) == (len(a.ids), len(b))
    assert set(got) == {*want, *long}
    # Counts are of the whole corpus: links of long texts come from the groups of the operator.
    counts = collections.Counter(x for w in want.values() for x in w[2])
    for row in alignment.aligned_groups(texts.where("length(text) >= 5000"), BYTES, PIECES).collect():
        counts[row.a[-1], row.b[-1]] += 1
    top = collections.Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    for key, (n_a, n_b, links, groups) in want.items():
        r = got[key]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, len(links), len(links)), key
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        assert r.n_best == sum(counts[x] == top[x[1]] for x in links)
        assert r.count_sum == sum(counts[x] for x in links)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_chunks_have_the_tokens_of_the_text(libraries, text):
    aligner = ALIGNER or ALIGNER_OF(contents(BYTES), contents(PIECES))
    pieces = aligner.cut(text)
    assert "".join(pieces) == (" " + text if text else "")
    if pieces:
        a = [i for x in aligner.a.encode_batch(pieces, add_special_tokens=False) for i in x.ids]
        assert a == libraries[0].encode(" " + text, add_special_tokens=False).ids
        flat_a, _, flat_b, _, good = aligner.encode(pieces)
        if good.all():
            assert flat_a.tolist() == a and flat_b.tolist() == libraries[1].encode(text)
        else:
            assert "▁" in text


ALIGNER = None


def ALIGNER_OF(*files):
    global ALIGNER
    ALIGNER = alignment.Aligner(*files)
    return ALIGNER


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(1, n)), st.sets(st.integers(1, n)))))
def test_coalescing_breaks_where_both_end(drawn):
    n, cuts_a, cuts_b = drawn
    ends = [np.array(sorted(c | {n})) for c in (cuts_a, cuts_b)]
    sizes = [np.diff(e, prepend=0) for e in ends]
    groups = alignment.coalesce(*ends, *sizes)
    shared = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    for end, group in zip(ends, groups, strict=True):
        assert group.tolist() == [sum(s < e for s in shared) for e in end.tolist()]
    pairs = set(zip(*(x.tolist() for x in alignment.overlaps(*ends, *sizes)), strict=True))
    spans = [list(zip((e - s).tolist(), e.tolist(), strict=True)) for e, s in zip(ends, sizes, strict=True)]
    assert pairs == {(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e}


def test_groups_tile_the_text(spark, texts):
    rows = alignment.aligned_groups(texts.where("doc_id < 20"), BYTES, PIECES).orderBy("doc_id", "start").collect()
    size = {r.doc_id: len((r.text or "").encode()) + 1 for r in texts.where("doc_id < 20").collect()}
    for key in size:
        own = [r for r in rows if r.doc_id == key]
        assert own[0].start == 0 and own[-1].end == size[key]
        assert all(x.end == y.start for x, y in zip(own, own[1:], strict=False))


def test_alignment_of_odd_tables(spark):
    rows = [(1, "a b", 0, 0), (1, "a b", 0, 0), (None, "a b", 0, 0), (None, None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block long, pairs long")
    got = sorted(alignment.align_texts(docs, BYTES, PIECES).select("n_a", "count_sum").collect())
    assert [tuple(r) for r in got] == [(0, 0), (2, 6), (2, 6), (2, 6)]
    assert alignment.align_texts(docs.where(F.lit(False)), BYTES, PIECES).count() == 0
    assert alignment.aligned_groups(docs.where(F.lit(False)), BYTES, PIECES).count() == 0


@pytest.mark.parametrize("path", [BYTES, WORDS, PIECES])
def test_counts_equal_the_library_cold_and_warm(spark, texts, path):
    cache = tempfile.mkdtemp(prefix="run-")
    if path.endswith(".json"):
        library = Tokenizer.from_file(path)
        want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in texts.collect()}
    else:
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        want = {r.doc_id: len(library.encode(r.text or "")) for r in texts.collect()}
    size = {r.doc_id: len((r.text or "").encode()) for r in texts.collect()}
    half = texts.where("doc_id % 2 = 0")
    for part in (half, texts, texts):
        got = token_counts.token_counts(part, path, cache).collect()
        assert {r.doc_id: r.n_tokens for r in got}.items() <= want.items()
        assert all(r.n_bytes == size[r.doc_id] and r.over_limit == (r.n_tokens > 1024) for r in got)
    assert len(got) == len(want)


def test_only_distinct_misses_are_encoded(spark, texts):
    cache = tempfile.mkdtemp(prefix="run-")
    copies = texts.union(texts).union(texts)
    distinct = texts.select(F.coalesce("text", F.lit(""))).distinct().count()

    def stored():
        return spark.read.option("recursiveFileLookup", "true").parquet(cache).count()

    token_counts.token_counts(texts.where("doc_id % 3 = 0"), BYTES, cache)
    before = stored()
    assert token_counts.token_counts(copies, BYTES, cache).count() == copies.count()
    assert stored() == distinct > before
    token_counts.token_counts(copies, BYTES, cache)
    assert stored() == distinct
    # Another tokenizer does not see these counts.
    token_counts.token_counts(texts, PIECES, cache)
    assert stored() == 2 * distinct


def test_misses_too_many_to_send_out(spark, texts, monkeypatch):
    want = sorted(token_counts.token_counts(texts, BYTES, tempfile.mkdtemp(prefix="run-")).collect())
    monkeypatch.setattr(token_counts, "BROADCAST_MISSES", 0)
    assert sorted(token_counts.token_counts(texts, BYTES, tempfile.mkdtemp(prefix="run-")).collect()) == want


def test_counts_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", b"x", 1), (1, "a b", b"y", 2), (None, None, None, None)], "doc_id long, text string, content binary, n_tokens long")
    cache = tempfile.mkdtemp(prefix="run-")
    got = [tuple(r) for r in token_counts.token_counts(docs, BYTES, cache).orderBy("n_tokens").collect()]
    assert got == [(None, 0, 0, False), (1, 3, 2, False), (1, 3, 2, False)]
    assert token_counts.token_counts(docs.where(F.lit(False)), BYTES, cache).count() == 0


def test_normal_form_keeps_special_strings_apart():
    form = token_counts.normal_form(WORDS, contents(WORDS))
    assert form("Ab  C") == form("ab c") != form("ab d")
    assert form("<|ENDOFTEXT|>") != form("<|endoftext|>")
    assert token_counts.normal_form(BYTES, contents(BYTES)) is None


def plain_negatives(rows):
    """The contract by loops: rows of (id, label, vector), ids distinct and not null."""
    rows = [(i, l, [math.floor(256.0 * float(x)) for x in v]) for i, l, v in rows]
    out = set()
    for i, label, v in rows:
        if i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, m) for j, m, w in rows if j != i)
        for p, j, m in [x for x in scored if x[2] == label][:5]:
            fits = [(n, k) for n, k, o in scored if o != label and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out |= {(i, j, r + 1, k, -p, -n) for r, (n, k) in enumerate(fits)}
    return out


VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("block, at_once, buffered", [(2 << 20, 2 << 20, 1 << 18), (9, 7, 5)])
def test_negatives_against_plain_loops(spark, monkeypatch, block, at_once, buffered):
    for name, value in (("BLOCK_NUMBERS", block), ("SCORES_AT_ONCE", at_once), ("BUFFERED", buffered)):
        monkeypatch.setattr(negatives, name, value)
    random = np.random.default_rng(3)
    rows = [(i - 40, int(random.integers(3)), np.round(random.normal(size=3) * 2) / 2) for i in range(240)]
    # A common vector and a common label; ties everywhere, scores of zero too.
    rows = [(i, 1 if i % 3 else label, np.array([0.5, 0.0, 0.5]) if i % 4 == 0 else v) for i, label, v in rows]
    frame = spark.createDataFrame([(i, v.tolist(), label) for i, label, v in rows], VECTORS).repartition(5)
    got = [tuple(r) for r in negatives.hard_negatives(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_negatives([(i, label, v.tolist()) for i, label, v in rows])


def test_negatives_of_odd_rows(spark):
    good = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 0.0], 2), (2, [0.75, 0.0], 2), (None, [0.75, 0.5], 2), (None, [0.5, 0.0], 2)]
    bad = [(50, None, 1), (100, [1.0, 0.0], None), (3, [float("nan"), 0.0], 2), (4, [float("inf"), 0.0], 2), (5, [None, 1.0], 2), (6, [1.0], 2), (7, [], 2)]
    frame = spark.createDataFrame(good + bad, VECTORS).withColumn("id", F.lit("x")).withColumn("vector", F.lit(1)).withColumn("block", F.lit(1))
    got = sorted(tuple(r) for r in negatives.hard_negatives(frame).collect())
    assert got == [(0, 1, 1, 2, 65536, 49152), (0, 1, 2, None, 65536, 49152), (0, 1, 3, None, 65536, 32768)]
    assert negatives.hard_negatives(frame.where(F.lit(False))).count() == 0
    huge = spark.createDataFrame([(0, [1e18, 1.0], 1), (1, [1e18, 1.0], 1), (2, [1e18, 1.0], 2)], VECTORS)
    assert negatives.hard_negatives(huge).count() == 0  # scores held at 2**63 - 1: no negative below 95 per cent


def test_scores_are_exact_beyond_doubles():
    left, right = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [2.0**40, 0.0]])
    assert negatives.scores(left, right).tolist() == [[2**60 + 3, negatives.MOST]]


def test_keys_sort_like_the_stream():
    entries = [(a, s, n, i) for a in (-50, 0, 50) for s in (negatives.LEAST, -1, 0, 7, negatives.MOST) for n in (False, True) for i in (-3, 0, 9, None)]
    want = sorted(entries, key=lambda e: (e[0], -e[1], e[2], e[3] is None, e[3] or 0))
    assert [negatives.unpack(k) for k in sorted(negatives.pack(*e) for e in entries)] == [(a, s, n, i) for a, s, n, i in want]


def test_cutting():
    assert chunks.cut("") == [] and chunks.cut(" a  b c") == [" a", "  b", " c"] and chunks.cut("a\n b ") == ["a\n b", " "]


def test_a_worker_keeps_nothing_of_the_tokenizers_of_earlier_tasks():
    code = """
import random, re, sys
from tideline.llm.chunks import ids_of, json_tokenizer

content = open(sys.argv[1], "rb").read()
pick = random.Random(1)
words = [" " + "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(15_000)]

def held():
    return sum(map(int, re.findall(r"Anonymous: +([0-9]+)", open("/proc/self/smaps_rollup").read()))) / 1024

for task in range(24):
    sum(map(len, ids_of(json_tokenizer(content), words)))
    if task == 5:
        before = held()
print(held() - before)
"""
    root = str(Path(__file__).parents[2])
    ran = subprocess.run([sys.executable, "-c", code, BYTES], capture_output=True, text=True, cwd=root, check=True)
    assert float(ran.stdout) < 20
