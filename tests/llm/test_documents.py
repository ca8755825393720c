import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import WORD, groups, repeated_lines
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loanloom.llm import line_dedup, mixing, packing, passages, prefix_tree
from loanloom.llm.components import components
from loanloom.llm.prefix_tree import Trie

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, copies string, n_lines string, cls string, start string"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def frame(spark, rows):
    """Rows of (id, text) or (id, text, source), with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, "a", "b", "c", "d", "e") for r in rows], SCHEMA)


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n))


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(5)
    base = [words(rng, 120).split() for _ in range(6)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i, w in enumerate(base[:4]):
        for c in range(4):
            near = list(w)
            for at in rng.choice(120, c, replace=False):
                near[at] = "changed"
            rows.append((10 + 4 * i + c, " ".join(near)))
    passage = words(rng, 30)
    rows += [(40 + i, f"{words(rng, 60)}\n{passage}\n{words(rng, 40)}") for i in range(8)]
    rows += [(60, None), (61, ""), (62, "  \n "), (63, "one two"), (64, "One\ttwo"), (65, "x"), (66, words(rng, 30_000)), (67, "Ünï cödé ÀB 你好 \U0001f600 " * 5)]
    return rows


def test_packing_is_a_round_trip(spark, odd):
    rows = odd + [(None, "no number"), (0, odd[0][1]), (70, "ΑΣ ΟΔΟΣ. İ. it's<|endoftext|>x\tb c, A.B,. 'S 3,4")]
    pieces = packing.pack(frame(spark, rows).repartition(3)).toPandas()
    left = {}
    for i, t in rows:
        left.setdefault(i, []).append(TOKENIZER.encode(t or "", add_special_tokens=False).ids + [1])
    for i, texts in left.items():
        own = pieces[pieces.doc_id.isna()] if i is None else pieces[pieces.doc_id == i]
        got = sorted(zip(own.start, own.length, own.ids, own.doc_tokens))
        want = sorted((s, len(t[s : s + 2048]), np.array(t[s : s + 2048], dtype="<u4").tobytes(), len(t)) for t in texts for s in range(0, len(t), 2048))
        assert got == want
    for _, sequence in pieces.sort_values("offset").groupby("sequence_id"):
        ends = sequence.length.cumsum()
        assert list(sequence.offset) == [0, *ends[:-1]] and ends.iloc[-1] <= 2048
    used = pieces.groupby("sequence_id").length.sum()
    assert used.sum() / 2048 > len(used) - 2
    one = bytes(pieces.ids.iloc[0])
    assert packing.pack(frame(spark, [])).count() == 0 and zlib.crc32(one) >= 0


def test_the_tokenizer_gets_bounded_texts(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [words(rng, 3000) + f" a{i}b, x{i}. 7{i}" for i in range(4)] + [None, ""]
    seen = []

    class Watched:
        get_vocab = TOKENIZER.get_vocab

        def encode_batch_fast(self, some, **kw):
            seen.append((len(some), max((len(t.split()) for t in some), default=0)))
            return TOKENIZER.encode_batch_fast(some, **kw)

    monkeypatch.setattr(packing, "_tokenizer", lambda path: Watched())
    monkeypatch.setattr(packing, "ENCODED", 100, raising=False)
    monkeypatch.setattr(packing, "GATHERED", 70, raising=False)
    ids, bounds = packing.token_ids(pa.array(texts), public_tokenizers.path("word_bpe_49k.json"))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert max(max(s) for s in seen) <= 100


def test_windows_are_bounded_and_best_fit():
    w = packing._Windows(10, 2, 0)
    assert w.put(1, 0, b"\0" * 4 * 6, 6) is None and w.put(2, 0, b"\0" * 4 * 8, 8) is None
    full = w.put(3, 0, b"\0" * 4 * 2, 2)  # fits both, goes to the fuller
    assert [(p[0], p[6]) for p in full] == [(2, 0), (3, 8)]
    w.put(4, 0, b"\0" * 4 * 7, 7)
    assert [p[0] for p in w.put(5, 0, b"\0" * 4 * 9, 9)] == [4] and len(w.open) == 2


def test_mix_reaches_its_targets(spark):
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for source, docs in (("b", 400), ("a", 60), (None, 50), ("c", 30), ("é", 5), ("z", 0)):
        for _ in range(docs):
            rows.append((n, words(rng, int(rng.integers(1, 40))), source))
            n += 1
    rows += [(n, None, "a"), (n + 1, "", "b"), (n + 2, "  ", "empty"), (None, "no number", "b"), (None, "no number", "b")]
    m = mixing.measured(frame(spark, rows), ["doc_id", "source", "copies"]).cache()
    got = mixing.mix(m, mixing.plan(m)).toPandas()
    size = {s: sum(len(re.findall(WORD, r[1] or "")) for r in rows if r[2] == s) for s in {r[2] for r in rows}}
    order = sorted(s for s in size if s is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(size.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = {s: 3.0 * size[s] for s in free if level * weight[s] > 3 * size[s]}
        if not over:
            break
        fixed |= over
    assert len(got) == len(rows) and (got.taken <= 3 * got["_size"]).all()
    for s in order:
        own = got[got.source.isna()] if s is None else got[got.source == s]
        assert own.target.iloc[0] == pytest.approx(fixed.get(s, level * weight[s])) and own.source_size.iloc[0] == size[s]
        assert abs(own.taken.sum() - own.target.iloc[0]) <= 4
    again = mixing.mix(m, mixing.plan(m.repartition(5).cache())).toPandas()
    key = ["doc_id", "taken", "_size"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist() or got.doc_id.isna().any()
    empty = mixing.measured(frame(spark, []), ["doc_id"])
    assert mixing.mix(empty, mixing.plan(empty)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_subset_sum_is_the_best(seed):
    rng = np.random.default_rng(seed)
    lengths, counts = rng.choice(np.arange(3, 40), 5, replace=False), rng.integers(1, 4, 5)
    budget = int(rng.integers(1, lengths @ counts + 1))
    sums = {0}
    for length, count in zip(lengths.tolist(), counts.tolist()):
        sums = {s + c * length for s in sums for c in range(count + 1)}
    taken = mixing.subset_sum(lengths, counts, budget)
    assert (taken <= counts).all() and lengths @ taken == max(s for s in sums if s <= budget)


@pytest.mark.parametrize("window,long_line", [(2, 50), (3, 8), (1, 1000)])
def test_line_dedup(spark, window, long_line):
    rng = np.random.default_rng(window)
    lines = ["", " ", *[words(rng, int(n)) for n in rng.integers(1, 12, 9)]]
    texts = {i: "\n".join(rng.choice(lines, int(rng.integers(1, 14)))) for i in range(60)} | {60: None, 61: "", 62: "\n\n", 63: words(rng, 60), 64: " x\n y"}
    texts |= {65: texts[63], 66: texts[64]}
    got = line_dedup.without_repeats(frame(spark, list(texts.items())), window, long_line).collect()
    gone = repeated_lines(texts, window, long_line)
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id]
        want = t if t is None or not gone[r.doc_id] else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[r.doc_id])
        assert (r.text, r.n_deleted, r.n_lines) == (want, len(gone[r.doc_id]), 0 if t is None else t.count("\n") + 1), r.doc_id


def test_line_dedup_edges(spark):
    assert line_dedup.without_repeats(frame(spark, [])).count() == 0
    twice = [(1, "a\nb"), (1, "a\nb"), (None, "a\nb"), (None, "a\nb")]
    assert sorted((r.doc_id or 0, r.text) for r in line_dedup.without_repeats(frame(spark, twice)).collect()) == [(0, ""), (0, ""), (1, "a\nb"), (1, "a\nb")]
    long = "\n".join(f"line {i}" for i in range(20_000))
    assert [len(r.text) for r in line_dedup.without_repeats(frame(spark, [(1, long), (2, long)])).orderBy("doc_id").collect()] == [len(long), 0]


def test_repeated_passages(spark):
    rng = np.random.default_rng(12)

    def some(n):
        return " ".join(str(w) for w in rng.integers(0, 10**9, n))

    p, q, short, loop = some(70), some(30) + "\n" + some(30), some(49), some(60)
    texts = {
        1: f"{some(9)} {p} {some(9)}\n{some(5)}", 2: f"one two {p.replace(' ', '  ', 5)} three\nfour", 3: f"head\nfive {q} six\nseven {short} eight",
        4: f"nine {q}\nten", 5: f"a {short} b", 6: f"c {p}", 7: f"{loop} x {loop} y", 8: None, 9: "", 10: p[: p.rindex(" ")] + "-",
        11: f"{p}\n\n{p}", 12: "w " * 300 + "z", 13: f"d {q.replace(chr(10), ' ')}",
    }
    want = texts | {2: "one two three\nfour", 4: "nine\nten", 6: "c", 7: f"{loop} x y", 10: texts[10].split(" ")[-1], 11: "", 12: "w " * 50 + "z"}
    got = {r.doc_id: r.text for r in passages.without_repeats(frame(spark, list(texts.items()))).collect()}
    assert got == want


@pytest.mark.parametrize("n,num", [(4, 85), (5, 80), (1, 50)])
def test_jaccard_join(spark, odd, n, num):
    root, sizes = groups(dict(odd), n, num, 100)
    got = prefix_tree.join(frame(spark, odd), n, num, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (sizes[i], root[i]) for i in root}
    assert {r.doc_id for r in got if r.stays} == {i for i in root if root[i] == i or sizes[i] == 0}


def test_jaccard_join_without_hubs_and_in_blocks(spark, odd, monkeypatch):
    """The tries alone find every link, also when a list is met block against block."""
    monkeypatch.setattr(prefix_tree, "BLOCK", 3)
    monkeypatch.setattr(prefix_tree, "HUBS", 1)
    monkeypatch.setattr(prefix_tree, "BROADCAST_CLASSES", 0)
    linked = prefix_tree._linked
    calls = []
    monkeypatch.setattr(prefix_tree, "_linked", lambda s, p, a, b: linked(s, p if calls.append(1) or len(calls) > 1 else p.limit(0), a, b))
    root, _ = groups(dict(odd), 4, 85, 100)
    assert {r.doc_id: r.component_id for r in prefix_tree.join(frame(spark, odd), 4, 85, 100).collect()} == root


def test_near_copies_below_the_bound_give_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base, rows = words(rng, 120).split(), []
    for i in range(60):
        near = list(base)
        for at in rng.choice(np.arange(5, 115), 2, replace=False):
            near[at] = f"changed{i}x{at}"
        rows.append((i, " ".join(near)))
    rows.append((60, rows[7][1] + " more"))
    stored, materialized = [], prefix_tree.materialized

    def counted(df, label):
        out = materialized(df, label)
        stored.append((label, out.count()))
        return out

    monkeypatch.setattr(prefix_tree, "materialized", counted)
    monkeypatch.setattr(prefix_tree, "HUBS", 1)
    got = {r.doc_id: r.component_id for r in prefix_tree.join(frame(spark, rows), 4, 85, 100).collect()}
    root, _ = groups(dict(rows), 4, 85, 100)
    assert got == root and root[60] == 7
    assert max(n for label, n in stored if label == "pairs") < 600  # of 1,830


@pytest.mark.parametrize("num", [80, 85])
def test_sketches_lose_no_link(num):
    rng = np.random.default_rng(num)
    sets = []
    for n in [1, 2, 5, 31, 33, 100, 130, 600, 5000]:
        base = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
        for lost in [0, 0.05, 0.1, 0.2, 0.6]:
            kept = base[: n - int(n * lost)]
            sets += [np.unique(kept), np.unique(np.concatenate([kept, rng.integers(0, 2**63, int(n * lost / 2), dtype=np.uint64)]))]
    sizes = np.array([len(s) for s in sets])
    a, b = np.triu_indices(len(sets), 1)
    common = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)])
    linked = 100 * common >= num * (sizes[a] + sizes[b] - common)
    keep = prefix_tree._close([prefix_tree._sketch(s) for s in sets], sizes, a, b, num, 100)
    assert keep[linked].all() and linked.sum() > 50 and keep[~linked].mean() < 0.5


def test_jaccard_join_edges(spark):
    assert prefix_tree.join(frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (3, "A b c d e f g"), (3, "A b c d e f g"), (None, "q r s t u v"), (7, None)]
    got = sorted(((r.doc_id or 0, r.component_id, r.stays) for r in prefix_tree.join(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(0, 3, False)] * 2 + [(3, 3, True)] * 2 + [(0, None, True), (7, 7, True)], key=str)


@pytest.mark.parametrize("num", [50, 60, 85])
def test_trie_probe_keeps_every_link(num):
    rng = np.random.default_rng(num)
    sets = [sorted(rng.choice(60, int(rng.integers(8, 20)), replace=False).tolist()) for _ in range(60)]
    sets += [sorted({*s[:-2], *rng.choice(60, 2).tolist()}) for s in sets[:30]] + sets[:3]
    den = 100
    prefixes = [s[: len(s) - -(-num * len(s) // den) + 1] for s in sets]
    trie = Trie(prefixes, [len(s) for s in sets], num, den)
    for i in range(len(sets)):
        trie.put(i)
    kept = 0
    for i, s in enumerate(sets):
        found = trie.probe(i, list(range(len(sets))))
        kept += len(found)
        for j, t in enumerate(sets):
            common = len(set(s) & set(t))
            # Sets of which neither prefix reaches into the other cannot meet in a list either.
            if j != i and den * common >= num * (len(s) + len(t) - common):
                assert j in found
    assert kept < len(sets) * (len(sets) - 1) / 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 60), (60, 80), (80, 100), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {60: 60, 80: 60, 100: 60}
    assert components(spark.createDataFrame([], "a long, b long").select(F.col("a"), F.col("b"))).count() == 0
