"""Alignment, packing and periodic runs against plain versions, and on odd inputs."""

import functools
import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brute import SPACED
from martlake.llm import align, packing, runs
from martlake.llm.common import prepare, stored
from martlake.llm.queries import QUERIES
from martlake.llm.textbytes import pieces

FOLDER = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
W_PATH = public_tokenizers.path("word_bpe_49k.json")
CLASHING = "n_words runs collapsed n_a groups link_a n_best key a b row ids rank part rest start sequence_id".split()
SCHEMA = "doc_id long, text string, " + ", ".join(f"{c} int" for c in CLASHING)
with_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def prose(seed, n, words=10):
    rng = random.Random(seed)
    return " ".join(rng.choice("ab cd efg hij klm nop qrs tuv wxy zab".split()[:words]) for _ in range(n))


ODD = [
    "", " ", "  ", "\n", "a▁b c", "▁ x", "x ▁ y", "don't 's 'll", "a  b   c\n\n d \t e  f   g",
    "<|endoftext|> <s> </s> <unk> <0x0A> <|startoftext|>x", "one\x00two \x85 ß 日本語 \U0001f600 MIT", " lead", "trail ",
    "á ́b   c", "x \u0085y \x1c z \x7f q", "Ünïcode ΣΑΣ ", "≠ Å",
]
ROWS = [
    (1, "same " * 200),
    (1, "same " * 200),
    (2, prose(1, 60_000)),
    (2, prose(2, 90, words=2)),
    (None, prose(3, 70)),
    (None, None),
    (3, None),
    *[(10 + i, text) for i, text in enumerate(ODD)],
]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame([(*r, *range(len(CLASHING))) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


# Periodic runs.


def plain_runs(words, least=6, exponent=4):
    found, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q) and not any(s <= i and j + q <= e and q % p == 0 for s, e, p in found):
                found.append((i, j + q, q))
            i = j + 1
    return sorted((s, e - s, q) for s, e, q in found)


def plain_collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_runs_of_random_words(monkeypatch):
    monkeypatch.setattr(runs, "CHUNK", 50)
    rng = random.Random(1)
    for _ in range(300):
        lists = []
        for _ in range(rng.randrange(0, 5)):
            n, k = rng.choice([0, 1, 5, 6, 20, 60, 150]), rng.choice([1, 2, 3, 10, 50])
            words = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.7:
                a = rng.randrange(n)
                p, b = 1 + rng.randrange((n - a) // 4 + 1), a + rng.randrange(n - a + 1)
                words = [words[a + (i - a) % p] if a <= i < b else words[i] for i in range(n)]
            lists.append(words)
        sizes = [len(x) for x in lists]
        text = np.repeat(np.arange(len(lists)), sizes)
        flat = np.array([w for x in lists for w in x], dtype=np.int64)
        _, numbers = np.unique(text * 1000 + flat, return_inverse=True)
        start, end, q = runs.find_runs(numbers, text)
        first = np.concatenate([[0], np.cumsum(sizes)])
        for k, words in enumerate(lists):
            mine = (start >= first[k]) & (start < first[k + 1])
            found = zip((start - first[k])[mine].tolist(), (end - start)[mine].tolist(), q[mine].tolist(), strict=True)
            assert list(found) == plain_runs(words)


def test_grammar_is_that_of_one_pair_at_a_time():
    """Rounds replace several pairs at once; the sizes are those of replacing the most frequent pair again and again."""
    words = np.array([int(c) for c in "121212341234512121234"], dtype=np.int64)
    grammar, symbol, start = runs.re_pair(words, np.zeros(len(words), dtype=np.int64))
    assert grammar.size[symbol].sum() == len(words)
    for left, right, place in zip(grammar.left, grammar.right, grammar.place, strict=True):
        assert grammar.size[left] + grammar.size[right] <= len(words) - place
    # No pair stands twice without overlap.
    pairs = Counter(zip(symbol.tolist(), symbol[1:].tolist(), strict=False))
    assert max(pairs.values()) == 1
    assert start.tolist() == [0, *np.cumsum(grammar.size[symbol])[:-1].tolist()]


def test_hashes_that_lie_are_found_out(monkeypatch):
    """Where hashes call unequal words equal, results are checked and other hashes taken."""
    real = runs.Hashes

    class First(real):
        def __init__(self, words, salt):
            super().__init__(words, salt)
            self.lies = salt == 0

        def equal(self, a, b, n):
            return np.ones(len(a), dtype=bool) if self.lies else super().equal(a, b, n)

    monkeypatch.setattr(runs, "Hashes", First)
    words = np.array([0, 1] * 5 + [2, 3, 4], dtype=np.int64)
    start, end, q = runs.find_runs(words, np.zeros(len(words), dtype=np.int64))
    assert (start.tolist(), end.tolist(), q.tolist()) == ([0], [10], [2])


def test_runs_of_odd_texts(docs, empty):
    found = runs.periodic_runs(docs).select("doc_id", "n_words", "runs", "collapsed", "key").collect()
    wanted = []
    for i, text in ROWS:
        words = SPACED.findall(text or "")
        if len(words) > 10_000:
            continue
        plain = plain_runs(words)
        wanted.append((i, len(words), plain, plain_collapsed(words, plain)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found if r.n_words < 10_000]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert len(found) == len(ROWS) and {r.key for r in found} == {CLASHING.index("key")}
    assert runs.periodic_runs(empty).count() == 0


@with_data
def test_runs_query(spark, texts):
    for r in QUERIES["op13_grammar_runs"](spark, FOLDER).collect():
        words = SPACED.findall(texts[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        if n > 3000:
            continue
        found = plain_runs(words)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
        milli = 1000 * best[1] // best[2] if found else None
        collapsed = plain_collapsed(words, found)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(found), *best, milli)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed.encode()).hexdigest()


# Alignment.


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        self.table = align.decode_table()

    def __call__(self, text):
        """Numbers of tokens and groups, the groups as text, and links by pair of ids."""
        nothing = (0, 0, 0, "", Counter())
        if not text:
            return nothing
        ids = [self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)]
        parts = [self.b.id_to_piece(i) for i in ids[1]]
        spelled = [
            [bytes(self.table[c] for c in self.a.id_to_token(i)) for i in ids[0]],
            [
                bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in zip(ids[1], parts, strict=True)
            ],
        ]
        if any(b"".join(x) != (" " + text).encode() for x in spelled):
            return nothing
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        groups, links, at = [], Counter(), [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            to = [ends[k].index(cut, at[k]) + 1 for k in range(2)]
            groups.append("|".join(",".join(map(str, ids[k][at[k] : to[k]])) for k in range(2)))
            for i in range(at[0], to[0]):
                for j in range(at[1], to[1]):
                    if ends[0][i] - len(spelled[0][i]) < ends[1][j] and ends[1][j] - len(spelled[1][j]) < ends[0][i]:
                        links[ids[0][i], ids[1][j]] += 1
            at = to
        return len(ids[0]), len(ids[1]), len(groups), ";".join(groups), links


def check_pieces(texts, plain):
    words = align.tokenizers(A_PATH, B_PATH)
    assert words.cuttable
    for piece in pieces(pa.array(texts, pa.string())):
        columns = [c.to_pylist() for c in align.align_piece(words, piece.data, piece.starts)]
        for i, (n_a, n_b, n_groups, n_links, groups, a, b, n) in enumerate(zip(*columns, strict=True)):
            wanted = plain(texts[piece.first + i])
            links = Counter(dict(zip(zip(a, b, strict=True), n, strict=True)))
            assert (n_a, n_b, n_groups, groups, links) == wanted
            assert n_links == sum(links.values())


def test_alignment_of_odd_texts(monkeypatch):
    plain = Plain()
    rng = random.Random(3)
    letters = list("ab  ''  \n\té日  ́.,12\x00")
    odd = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    texts = [*ODD, *odd, None, "x" * 3000, "same " * 2000]
    check_pieces(texts, plain)
    # Short lanes, whole texts instead of cuts, and a memory that forgets.
    monkeypatch.setattr(align, "LANE", 2)
    monkeypatch.setattr(align, "REMEMBER", 10)
    check_pieces(texts, plain)
    monkeypatch.setattr(align, "cut_places", lambda data, borders, _, real=align.cut_places: real(data, borders, False))
    check_pieces(texts, plain)


def test_alignment_of_odd_rows(spark, docs, empty, monkeypatch):
    for bound in (align.PAIRS, 0):
        # With a broadcast, and with a shuffle of the counts.
        monkeypatch.setattr(align, "PAIRS", bound)
        linked = stored(align.aligned(docs, A_PATH, B_PATH).withColumn("unique", F.monotonically_increasing_id()), "aligned")
        found = align.scored(linked, "unique").collect()
        assert len(found) == len(ROWS)
        plain = Plain()
        wanted = {text: plain(text) for _, text in ROWS if text is None or len(text) < 5000}
        long = next(text for _, text in ROWS if text and len(text) >= 5000)
        counts = Counter()
        for _, text in ROWS:
            counts.update((wanted[text] if text != long else plain_long(linked))[4])
        most = {}
        for (_, b), n in counts.items():
            most[b] = max(most.get(b, 0), n)
        by_numbers = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in found if r.n_a < 50_000)
        expected = Counter()
        for i, text in ROWS:
            if text != long:
                n_a, n_b, n_groups, groups, links = wanted[text]
                best = sum(n for (a, b), n in links.items() if counts[a, b] == most[b])
                total = sum(n * counts[p] for p, n in links.items())
                expected[i, n_a, n_b, n_groups, sum(links.values()), groups, best, total] += 1
        assert by_numbers == expected
    nothing = align.aligned(empty, A_PATH, B_PATH).withColumn("unique", F.monotonically_increasing_id())
    assert align.scored(stored(nothing, "aligned"), "unique").count() == 0


def plain_long(linked):
    """Links of the long text as the operator has them; its pieces are compared with the plain version elsewhere."""
    r = linked.filter("n_a >= 50000").select("link_a", "link_b", "link_n").first()
    return (None,) * 4 + (Counter(dict(zip(zip(r.link_a, r.link_b, strict=True), r.link_n, strict=True))),)


@with_data
def test_alignment_query(spark, texts):
    plain = Plain()
    wanted = {i: plain(t) for i, t in texts.items()}
    counts = Counter()
    for w in wanted.values():
        counts.update(w[4])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    found = QUERIES["op11_lockstep_alignment"](spark, FOLDER).collect()
    assert len(found) == len(texts)
    for r in found:
        n_a, n_b, n_groups, groups, links = wanted[r.doc_id]
        best = sum(n for (a, b), n in links.items() if counts[a, b] == most[b])
        total = sum(n * counts[p] for p, n in links.items())
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, n_groups, sum(links.values()))
        assert (r.n_best, r.count_sum, r.groups_sha256) == (best, total, digest)


# Packing.


def check_packed(rows, wanted_ids, size):
    """Whole documents in pieces, gapless sequences within the size; returns the share of padding."""
    held, sequences = Counter(), {}
    by_document = {}
    for r in rows:
        by_document.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= size
        held[end] += 1
    assert sorted(sequences) == list(range(len(sequences)))
    # Pieces of rows with one id and size are told apart by nothing, so they are compared as a whole.
    wanted = Counter()
    for i, ids in wanted_ids:
        wanted[i, len(ids)] += len(ids)
    assert {k: sum(r.length for r in v) for k, v in by_document.items()} == dict(wanted)
    tokens = sum(n * c for n, c in held.items())
    return sum((size - n) * c for n, c in held.items() if n & (n - 1)) / max(tokens, 1)


@functools.cache
def word_tokenizer():
    return Tokenizer.from_file(W_PATH)


def plain_ids(text):
    return [*word_tokenizer().encode(text or "", add_special_tokens=False).ids, 1]


def test_packing_of_odd_rows(spark, docs, empty, monkeypatch):
    wanted = [(i, plain_ids(text)) for i, text in ROWS]
    for size, remember in ((2048, packing.REMEMBER), (64, 5)):
        monkeypatch.setattr(packing, "REMEMBER", remember)
        rows = packing.packed(docs, W_PATH, 1, size).collect()
        check_packed(rows, wanted, size)
        unique = {i: ids for i, ids in wanted if i is not None and i >= 10}
        for r in rows:
            if r.doc_id in unique:
                part = unique[r.doc_id][r.start : r.start + r.length]
                assert bytes(r.ids) == np.array(part, dtype="<u4").tobytes()
    assert packing.packed(empty, W_PATH).count() == 0


def test_packing_has_little_padding(spark):
    prepare(spark)
    rng = random.Random(8)
    rows = [(i, prose(i, rng.choice([3, 9, 10, 21, 21, 21, 40, 63, 64, 200]))) for i in range(2000)]
    rows = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = packing.packed(rows, W_PATH, 1, 64).collect()
    wanted = [(r.doc_id, plain_ids(r.text)) for r in rows.collect()]
    assert check_packed(found, wanted, 64) < 0.01


@pytest.mark.parametrize("seed", range(4))
def test_cutting_stock(seed):
    """Uses cover the counts, and the objective is near the best that tokens allow."""
    rng = random.Random(seed)
    counts = {n: rng.randrange(1, 200) for n in rng.sample(range(1, 101), 40)}
    solution = packing.cutting_stock(counts, 100)
    made = Counter()
    for pattern, amount in solution:
        assert sum(n * k for n, k in pattern.items()) <= 100 and amount >= 0
        for n, k in pattern.items():
            made[n] += k * amount
    assert all(abs(made[n] - c) < 1e-6 for n, c in counts.items())
    plan = packing.packing_plan(counts, 100)
    taken = Counter()
    for n, begin, end, *_ in plan:
        assert begin == taken[n]
        taken[n] = end
    assert all(taken[n] <= c for n, c in counts.items())


def test_best_patterns():
    best, last = packing.knapsack(np.array([0, 0, 0, 0.5, 0, 0.9, 0, 0, 0, 0, 0]), 10)
    assert best[10] == pytest.approx(1.8) and packing.pattern_at(last, 10) == {5: 2}
    assert packing.pattern_at(last, 9) in ({3: 3}, {3: 1, 5: 1})
    assert packing.powers_of_two(1500) == [1024, 256, 128, 64, 16, 8, 4]
    # Lengths of three quarters of a sequence waste a third in patterns, so they are cut instead.
    assert packing.packing_plan({75: 10}, 100) == []


@with_data
def test_packing_query(spark, texts):
    rows = QUERIES["op12_column_packing"](spark, FOLDER).collect()
    wanted = {i: plain_ids(t) for i, t in texts.items()}
    check_packed(rows, list(wanted.items()), 2048)
    for r in rows:
        part = np.array(wanted[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes()
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part), len(wanted[r.doc_id]))
