"""Importance resampling, risk-controlled quality rules and Merkle manifests against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from brute import LOWER
from pyspark.sql import functions as F

from loanloom.llm import importance, manifest, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, place int, n_words string"


def corpus(n=300, seed=3):
    rng = np.random.default_rng(seed)
    voc = [f"{w}{i}" for i in range(20) for w in ("Alpha", "bêta", "GAMMA", "δ", "x_y", "don't")]
    texts = [" ".join(rng.choice(voc, rng.integers(0, 60))) for _ in range(n)]
    return [*texts, None, "", "  ", "ÀB\x00c-D", "a" * 5000, "word " * 3000, "\n".join(["same line here"] * 40)]


def frame(spark, texts, lang=lambda i: ["en", "de", None][i % 3]):
    return spark.createDataFrame([(i, t, lang(i), f"s{i % 4}", None if i % 5 == 0 else i, "clash", i, "clash") for i, t in enumerate(texts)], DOCS)


def features(text, ngram):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)]


def resampled(docs, target, ngram, buckets, least, per_cent):
    """``docs`` as (id, text)."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    found = [(i, *features(t, ngram)) for i, t in docs]
    s, t = Counter(bucket(f) for _, _, fs in found for f in fs), Counter(bucket(f) for x in target for f in features(x, ngram)[1])
    big_s, big_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, n_words, fs in found:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    order = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0]))
    drawn = {id(r): k for k, r in enumerate(order[: per_cent * len(order) // 100], 1)}
    return sorted(((*r[:4], drawn.get(id(r))) for r in rows), key=str)


@pytest.mark.parametrize(("ngram", "buckets"), [(1, 10_000), (1, 7), (3, 500)])
def test_resample(spark, ngram, buckets):
    texts = corpus()
    got = importance.resample(frame(spark, texts), frame(spark, texts[:20]), ngram, buckets, 20, 10)
    assert sorted((tuple(r) for r in got.collect()), key=str) == resampled(list(enumerate(texts)), texts[:20], ngram, buckets, 20, 10)


def test_resample_cases(spark):
    empty = frame(spark, []).limit(0)
    assert importance.resample(empty, empty).collect() == []
    docs = [(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (5, "a b c d"), (6, None), (7, "z " * 30)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = importance.resample(rows, empty, least_words=1, per_cent=50)
    assert sorted((tuple(r) for r in got.collect()), key=str) == resampled(docs, [], 1, 10_000, 1, 50)


def test_crc_matrices_of_every_length():
    rng = np.random.default_rng(1)
    values = [rng.bytes(int(n)) for n in [*range(70), 511, 512, 513, 9000]] * 2
    assert importance.crc32s(pa.array(values, pa.binary())).tolist() == [zlib.crc32(v) for v in values]


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_measures(spark):
    texts = [*corpus(60), "a b c a b c a", "a a a a", "x y z\nx y z\n \nx y z", "# * 😀 é|é", "p q r s p q r t q r s", "one\x0btwo\x85three four"]
    got = quality.measured(frame(spark, texts), ["doc_id"])
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect()} == dict(enumerate(map(measures, texts)))


def binomial(n, x, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)) for k in range(x + 1))


def test_binomial(spark):
    cases = [(1, 0), (50, 0), (50, 2), (1000, 7), (100_000, 900), (100_000, 0)]
    rows = spark.createDataFrame(cases, "n long, x long").select("n", "x", quality.log_binomial_cdf(F.col("n"), F.col("x"), 0.01).alias("p"))
    for r in rows.collect():
        want = binomial(r.n, r.x, 0.01)
        assert r.p == pytest.approx(math.log(want) if want else r.n * math.log1p(-0.01), rel=1e-9)


def labelled(spark, sizes, seed=0):
    """Good documents of which some have symbols, and bad ones that are full of them; ``sizes`` by stratum."""
    rng, docs, marks = np.random.default_rng(seed), [], []
    for lang, n in sizes.items():
        for _ in range(n):
            good = rng.random() < 0.8
            share = rng.choice([0, 0.01, 0.04, 0.12], p=[0.7, 0.25, 0.045, 0.005]) if good else rng.choice([0.12, 0.25])
            docs.append((len(docs), " ".join("#" * int(share * 100) + f"w{x}" for x in rng.integers(0, 10**6, 80)), lang, None, None, "c", 1, "c"))
            marks.append((len(marks), int(good)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(marks, "doc_id long, quality int"), marks


def test_cutoffs_limit_what_good_documents_lose(spark):
    docs, labels, marks = labelled(spark, {"en": 3000, None: 1500, "de": 100})
    rows = quality.measured(docs.withColumn("stratum", F.col("lang")), ["doc_id", "stratum"]).join(labels, "doc_id")
    chosen = quality.cutoffs(rows).cache()
    part, level = 0.05 / 5, 0.05 / (5 * 3)
    assert {r.stratum for r in chosen.collect()} == {"en", None}  # 100 labels prove nothing
    for r in chosen.collect():
        assert binomial(r.good, r.lost, part) <= level
        rule = next(x for x in quality.RULES if x.name == r.rule)
        stricter = [c for c in rule.cutoffs if c < r.cutoff]
        if stricter:
            lost = rows.filter((F.col("quality") == 1) & F.col("stratum").eqNullSafe(F.lit(r.stratum)) & rule.rejects(max(stricter))).count()
            assert lost >= r.good * part or binomial(r.good, lost, part) > level
    kept = {r.doc_id: r.kept for r in quality.filtered(docs, labels, "lang", F.lit(True)).collect()}
    good = [i for i, q in marks if q]
    assert sum(not kept[i] for i in good) <= 0.05 * len(good)
    assert sum(not kept[i] for i, q in marks if not q and i < 4500) > 400


def test_quality_cases(spark):
    docs, labels, _ = labelled(spark, {"en": 20})
    nothing = labels.limit(0)
    assert all(r.kept and r.rejected_by == "" for r in quality.filtered(docs, nothing, "lang", F.lit(True)).collect())
    assert quality.filtered(docs.limit(0), labels, "lang", F.lit(True)).collect() == []
    odd = spark.createDataFrame([(None, None, None), (1, "", "en"), (1, "a " * 60, "en"), (1, "a " * 60, "en")], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(1, None), (1, 1), (None, 0)], "doc_id long, quality int")
    assert sorted((r.n_words, r.base_failed, r.kept) for r in quality.filtered(odd, marks, "lang", F.lit(True)).collect()) == [
        (0, True, False), (0, True, False), (60, True, False), (60, True, False)]


def test_copies_count_once(spark):
    one = [(i, "plain # words " + " ".join(f"w{k}" for k in range(60)), "en") for i in range(5000)]
    rows = quality.measured(spark.createDataFrame(one, "doc_id long, text string, stratum string"), ["doc_id", "stratum"])
    assert quality.cutoffs(rows.withColumn("quality", F.lit(1))).collect() == []


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, arity):
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            first = p - p % arity
            steps[i].append(("".join(nodes[first:p]), "".join(nodes[p + 1 : first + arity])))
            at[i] = p // arity
        nodes = [h(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
    return steps, nodes[0] if nodes else None


def proofs(rows, arity):
    """``rows`` as (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: h(*map(field, r))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    low = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0], leaf(r))) for g in langs}
    trees = {g: tree([leaf(r) for r in low[g]], arity) for g in langs}
    rest, root = tree([trees[g][1] for g in langs], arity)
    out = []
    for g, more in zip(langs, rest, strict=True):
        for r, steps in zip(low[g], trees[g][0], strict=True):
            changed = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf((*r[:3], r[3] + 1, r[4])) if changed else leaf(r)
            for before, after in steps + more:
                node = h(before, node, after)
            out.append((r[0], leaf(r), trees[g][1], root, h(*(x for s in steps + more for x in s)), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize(("arity", "height"), [(2, 8), (2, 2), (3, 2)])
def test_manifest(spark, arity, height):
    texts = corpus(150)
    rows = [(i, f"s{i % 4}", ["en", "en", "en", "de", None, "é"][i % 6], None if i % 5 == 0 else i, t) for i, t in enumerate(texts)]
    rows += [(7, "s", "en", 1, "b"), (7, "s", "en", 1, "b"), (7, "s", "en", 1, "a"), (None, None, None, None, None), (999, "s", "alone", 3, "x"), (1000, "", "", 0, "")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, node string, place int")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    got = manifest.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "lang", tampered, {"n_chars": F.col("n_chars") + 1}, arity, height)
    assert sorted((tuple(r) for r in got.collect()), key=str) == proofs(rows, arity)


def test_manifest_of_nothing_and_of_one_row(spark):
    docs = spark.createDataFrame([(3, "text")], "doc_id long, lang string")
    make = lambda d: manifest.manifest(d, ["doc_id", "lang"], "doc_id", "lang", F.lit(None).cast("boolean"), {}).collect()
    assert make(docs.limit(0)) == []
    [row] = make(docs)
    assert row.leaf == row.subroot == row.root == row.folded_root == h("1:3", "4:text") and row.proof_sha256 == h("") and row.verified


def test_places_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), F.expr("id % 1000").alias("k"))
    a, b = (manifest.numbered(rows.repartition(n), ["g"], ["k"], "t").groupBy("g", "k").agg(F.sort_array(F.collect_list("place")).alias("p")) for n in (3, 40))
    assert a.exceptAll(b).count() == 0
    assert sorted(r.place for r in manifest.numbered(rows, ["g"], ["k"], "t").filter("g = 1").collect()) == list(range(1667))
    assert all(y.p[0] == x.p[-1] + 1 for x, y in pairwise(a.filter("g = 0").orderBy("k").collect()))
