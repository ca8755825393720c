"""N-gram Jaccard join with tries over globally ordered shingle sets."""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loanloom.llm.common import materialized, releasing
from loanloom.llm.components import components
from loanloom.llm.shingles import set_key, shingle_sets

#: Members of one posting list that one trie holds; longer lists are met block against block.
BLOCK = 1000
#: Rows of the posting lists that one task gets at a time.
BUCKET = 10_000
#: Classes whose numbers may be broadcast (8 MB); beyond that the same join shuffles.
BROADCAST_CLASSES = 1_000_000
#: Times that hubs are drawn for the first links.
HUBS = 3
DOCS_AT_ONCE = 500
#: Slots (as a power of two) by which frequent shingles are told, and tasks that add up their counts.
SLOT_BITS, MERGERS = 17, 32
#: Least and largest size of a set's sketch, in bits (as powers of two).
SKETCH_BITS = (6, 13)
#: Pairs of sketches compared at a time.
COMPARED = 1 << 14


def _least(n, num: int, den: int):
    """Shingles that a set of n shares at least with any partner: the ceiling of n * num / den."""
    return -(-num * n // den)


def _needed(n, m, num: int, den: int):
    """Overlap from which sets of n and m link: the ceiling of (n + m) * num / (num + den)."""
    return -(-num * (n + m) // (num + den))


def _sketch(grams: np.ndarray) -> bytes:
    """A bit for each slot, set where an odd number of the set's shingles fall: at least two bits a shingle, up to the largest size."""
    bits = 1 << min(max((2 * len(grams) - 1).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    slots = (grams >> np.uint64(24)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(slots.astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _close(sketches: list[bytes], sizes: np.ndarray, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs ``a``, ``b`` (places in ``sketches``) may link: every odd slot of one set alone takes a shingle that the other lacks. No link is lost.

    A slot of half as many is two slots taken together, so a longer sketch folds to the shorter one's size.
    """
    lengths = np.array([len(s) for s in sketches], dtype=np.int64)
    most = sizes[a] + sizes[b] - 2 * _needed(sizes[a], sizes[b], num, den)
    short = np.minimum(lengths[a], lengths[b])
    keep = np.zeros(len(a), dtype=bool)
    place = np.zeros(len(sketches), dtype=np.int64)
    for size in np.unique(short).tolist():
        rows = np.flatnonzero(short == size)
        used = np.unique(np.concatenate([a[rows], b[rows]]))
        place[used] = np.arange(len(used))
        held = np.empty((len(used), size // 8), dtype="<u8")
        for length in np.unique(lengths[used]).tolist():
            at = np.flatnonzero(lengths[used] == length)
            whole = np.frombuffer(b"".join(sketches[i] for i in used[at].tolist()), dtype="<u8")
            held[at] = np.bitwise_xor.reduce(whole.reshape(len(at), length // size, size // 8), axis=1)
        for low in range(0, len(rows), COMPARED):
            some = rows[low : low + COMPARED]
            odd = np.bitwise_count(held[place[a[some]]] ^ held[place[b[some]]]).sum(axis=1, dtype=np.int64)
            keep[some] = odd <= most[some]
    return keep


def _shingled(docs: DataFrame, n: int, with_grams: bool, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``cls`` (a number for the set, null for an empty one), and ``grams`` (sorted, 8 bytes each); without
    these, each task adds a row of ``loads``, its shingles by slot."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loads = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), DOCS_AT_ONCE):
                part = batch.iloc[at : at + DOCS_AT_ONCE]
                found = shingle_sets(part["text"].tolist(), n)
                if not with_grams:
                    loads += np.bincount(_slot(np.concatenate(found)), minlength=len(loads))
                out = pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(), "text_hash": part["text_hash"].to_numpy(), "n_shingles": [len(s) for s in found],
                        "cls": pd.array([set_key(s) if len(s) else None for s in found], dtype="Int64"),
                    }
                )
                yield out.assign(grams=[s.tobytes() for s in found]) if with_grams else out.assign(loads=None)
        if not with_grams:
            packed = pa.compress(loads, "zstd", asbytes=True)
            yield pd.DataFrame({"doc_id": [None], "text_hash": 0, "n_shingles": 0, "cls": pd.array([None], dtype="Int64"), "loads": [packed]})

    text = F.col(text_col)
    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.coalesce(text, F.lit("")).alias("text"))
    kind = f"doc_id string, text_hash long, n_shingles long, cls long, {'grams' if with_grams else 'loads'} binary"
    return texts.mapInPandas(releasing(sets), kind).withColumn("doc_id", F.col("doc_id").cast("long"))


class _Sets:
    """Shingle sets of documents. Only their numbers are stored; the sets are eight bytes a word, so they are made anew from the texts
    where they are needed, of the texts that are needed."""

    def __init__(self, docs: DataFrame, n: int, id_col: str, text_col: str):
        self.docs, self.n, self.columns = docs, n, (id_col, text_col)
        made = materialized(_shingled(docs, n, False, *self.columns), "sets")
        self.numbers, self.loads = made.filter("loads IS NULL").drop("loads"), made.filter("loads IS NOT NULL").select("loads")

    def grams(self) -> DataFrame:
        return _shingled(self.docs, self.n, True, *self.columns)

    def of(self, classes: DataFrame) -> DataFrame:
        """``cls``, ``grams`` of ``classes`` (stored, distinct ``cls``), from one text for each; copies of that text repeat it."""
        one = self.numbers.join(classes, "cls", "left_semi").groupBy("cls").agg(F.min("text_hash").alias("h")).select("h")
        few = classes.count() <= BROADCAST_CLASSES
        chosen = self.docs.join(F.broadcast(one) if few else one, F.xxhash64(F.col(self.columns[1])) == F.col("h"), "left_semi")
        return _shingled(chosen, self.n, True, *self.columns).select("cls", "grams")


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def frequent_slots(sets: _Sets) -> np.ndarray:
    """Which hashed slots hold frequent shingles, as flags for 2^``SLOT_BITS`` slots.

    The global order puts shingles of these slots last, so that passages in many documents stay out of the prefixes. A rare
    shingle that shares a slot is moved with them, which changes no result: any order that all sets share is right. Every task has one row of
    counts over all its documents; ``MERGERS`` tasks add them up, and one task theirs.
    """

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in batches:
            for packed in batch["loads"]:
                total += np.frombuffer(pa.decompress(packed, total.nbytes, "zstd", asbytes=True), dtype=np.int64)
        yield pd.DataFrame({"loads": [pa.compress(total, "zstd", asbytes=True)]})

    rows = sets.loads
    for tasks in (MERGERS, 1):
        rows = rows.repartition(tasks).mapInPandas(releasing(add), "loads binary")
    loads = np.frombuffer(pa.decompress(bytes(rows.first()["loads"]), 8 << SLOT_BITS, "zstd", asbytes=True), dtype=np.int64)
    mean = loads.mean()
    return loads > mean + 6 * mean**0.5 + 8


def _ordered(grams: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set in the global order, and its places as numbers that rise with the order: 15 bits of hash below the frequency flag.

    Different shingles may share a place. That only lets a pair pass that its whole sets then rule out.
    """
    late = flags[(grams & np.uint64(len(flags) - 1)).astype(np.int64)]
    order = np.argsort(late, kind="stable")  # hashes are sorted already
    grams, late = grams[order], late[order]
    return grams, (grams >> np.uint64(49)).astype(np.uint16) | (late.astype(np.uint16) << np.uint16(15))


def _prefixes(sets: _Sets, flags: np.ndarray, num: int, den: int) -> DataFrame:
    """``cls``, ``n``, ``prefix`` (its shingles, in order), ``sketch`` of every class, once a task. Linked sets share a shingle among their first
    n - least + 1."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        for batch in batches:
            rows = []
            for cls, n, data in zip(batch["cls"], batch["n_shingles"], batch["grams"], strict=True):
                least = int(_least(n, num, den))
                if cls in done or (least == n and n * den // num == n):  # only its own copies could link
                    continue
                done.add(cls)
                grams = np.frombuffer(data, dtype="<u8")
                rows.append((cls, n, _ordered(grams, flags)[0][: n - least + 1].view(np.int64), _sketch(grams)))
            if rows:
                yield pd.DataFrame(rows, columns=["cls", "n", "prefix", "sketch"])

    grams = sets.grams().filter("cls is not null").select("cls", "n_shingles", "grams")
    return grams.mapInPandas(releasing(emit), "cls long, n long, prefix array<long>, sketch binary")


def _linked(sets: _Sets, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` (stored: ``a``, ``b``) whose whole sets link."""
    wanted = materialized(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct(), "classes")
    own = materialized(sets.of(wanted).groupBy("cls").agg(F.first("grams").alias("grams")), "class-sets")
    both = pairs.join(own.select(F.col("cls").alias("a"), F.col("grams").alias("x")), "a").join(
        own.select(F.col("cls").alias("b"), F.col("grams").alias("y")), "b"
    )

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                keep.append(den * common >= num * (len(x) + len(y) - common))
            yield batch.loc[keep, ["a", "b"]]

    return materialized(both.mapInPandas(releasing(check), "a long, b long"), "links")


def _plausible(prefixes: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` (stored: ``a``, ``b``) whose sketches allow a link."""
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    own = materialized(prefixes.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("n").alias("n"), F.first("sketch").alias("s")), "sketches")
    both = pairs.join(own.toDF("a", "n", "x"), "a").join(own.toDF("b", "m", "y"), "b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                sizes, at = np.concatenate([batch["n"].to_numpy(), batch["m"].to_numpy()]), np.arange(len(batch))
                yield batch.loc[_close([*batch["x"], *batch["y"]], sizes, at, at + len(batch), num, den), ["a", "b"]]

    return materialized(both.mapInPandas(releasing(check), "a long, b long"), "pairs")


class _Leaf:
    """Members with one and the same prefix, whose path no other prefix shares from here on."""

    __slots__ = ("members",)

    def __init__(self, member: int):
        self.members = [member]


class _Node:
    __slots__ = ("children", "members", "least", "most")

    def __init__(self, size: int):
        self.children: dict[int, _Node | _Leaf] = {}
        self.members: list[int] = []  # whose prefix ends here
        self.least = self.most = size  # shingles of the sets below

    def holds(self, size: int) -> None:
        if size < self.least:
            self.least = size
        elif size > self.most:
            self.most = size


class Trie:
    """Ordered prefixes by their common beginnings; a path that belongs to one prefix alone is kept as its end.

    ``sequences`` are ascending places, ``sizes`` the shingles of the whole sets.
    """

    def __init__(self, sequences: list[list[int]], sizes: list[int], num: int, den: int):
        self.sequences, self.sizes, self.num, self.den = sequences, sizes, num, den
        self.sets = [frozenset(s) for s in sequences]
        self.root = _Node(0)

    def put(self, i: int) -> None:
        sequence, size, node = self.sequences[i], self.sizes[i], self.root
        if not node.least:
            node.least = node.most = size
        node.holds(size)
        for depth, place in enumerate(sequence):
            child = node.children.get(place)
            if child is None:
                node.children[place] = _Leaf(i)
                return
            if isinstance(child, _Leaf):
                j = child.members[0]
                other = self.sequences[j]
                if other == sequence:
                    child.members.append(i)
                    return
                inner = _Node(self.sizes[j])
                for m in child.members:
                    inner.holds(self.sizes[m])
                if depth + 1 < len(other):
                    inner.children[other[depth + 1]] = child
                else:
                    inner.members = child.members
                node.children[place] = child = inner
            node = child
            node.holds(size)
        node.members.append(i)

    def probe(self, i: int, parts: list) -> list[int]:
        """Members of other ``parts`` that may link to ``i``.

        A place that is below the probe's last and not in its prefix is not in its set at all. A member of m shingles can miss
        at most m - needed, which rises with m, so a subtree goes as soon as its largest set cannot afford the misses of the path;
        so do sizes that no partner can have. What several members share is walked once; at an end the rest is one intersection.
        """
        num, whole = self.num, self.num + self.den
        own, last, size, part = self.sets[i], self.sequences[i][-1], self.sizes[i], parts[i]
        sizes, sets, sequences = self.sizes, self.sets, self.sequences
        low, high = _least(size, num, self.den), size * self.den // num
        found: list[int] = []
        stack = [(self.root, 0)]
        while stack:
            node, misses = stack.pop()
            if node.most < low or node.least > high:
                continue
            most = min(node.most, high)
            if misses > most + (-num * (size + most) // whole):  # most - needed(size, most)
                continue
            for j in node.members:
                if parts[j] != part and low <= sizes[j] <= high and misses <= sizes[j] + (-num * (size + sizes[j]) // whole):
                    found.append(j)
            for place, child in node.children.items():
                if child.__class__ is _Node:
                    stack.append((child, misses + (place < last and place not in own)))
                    continue
                missed = -1
                for j in child.members:
                    m = sizes[j]
                    if parts[j] == part or not low <= m <= high:
                        continue
                    if missed < 0:
                        missed = bisect.bisect_left(sequences[j], last) - len(own & sets[j]) + (last in sets[j])
                    if missed <= m + (-num * (size + m) // whole):
                        found.append(j)
        return found


def _candidates(lists: DataFrame, prefixes: DataFrame, flags: np.ndarray, num: int, den: int) -> DataFrame:
    """``a``, ``b``: pairs of classes of different components that share a list and that neither the tries nor the sketches rule out."""

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["cls", "sketch"]].assign(
                places=[_ordered(np.asarray(p, dtype=np.int64).view(np.uint64), flags)[1].tobytes() for p in batch["prefix"]]
            )

    asked = prefixes.join(lists.select("cls").distinct(), "cls", "left_semi").select("cls", "prefix", "sketch")
    asked = asked.mapInPandas(releasing(placed), "cls long, sketch binary, places binary")
    own = asked.groupBy("cls").agg(F.first("places").alias("places"), F.first("sketch").alias("sketch"))
    rows = lists.withColumn("blocks", F.ceil(F.col("members") / BLOCK)).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.select(
        "first", "second", "cls", "n", "component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") <= F.col("other")).alias("stored"),
    )
    cell = ["first", "second", "low", "high"]
    buckets = max(1, -(-lists.count() // BUCKET))
    # Lists of one first class share most of their members and pairs; each bucket gets a class's places and sketch once, in a row of its own.
    cells = cells.withColumn("bucket", F.pmod(F.xxhash64("first", "low", "high"), F.lit(buckets)))
    held = cells.select("bucket", "cls").distinct().join(own, "cls")
    none = {c: F.lit(0).cast("long") for c in ("first", "second", "n", "component", "low", "high")}
    rows = cells.withColumns({"places": F.lit(None).cast("binary"), "sketch": F.lit(None).cast("binary")})
    rows = rows.unionByName(held.withColumns(none | {"stored": F.lit(False)}))

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        alone = rows["places"].notna()
        held, group = rows[alone], rows[~alone].sort_values(cell, ignore_index=True)
        key = group[cell].to_numpy()
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(group)]
        classes = held["cls"].to_numpy()
        number = pd.Index(classes).get_indexer(group["cls"])
        n = np.zeros(len(classes), dtype=np.int64)
        n[number] = group["n"]
        known = [list(dict.fromkeys(np.frombuffer(p, dtype="<u2").tolist())) for p in held["places"]]
        numbers, parts, sizes, stored = number.tolist(), *(group[c].tolist() for c in ("component", "n", "stored"))
        same_block = (key[:, 2] == key[:, 3]).tolist()
        found: set[tuple[int, int]] = set()
        for start, end in itertools.pairwise(cuts):
            own = parts[start:end]
            if len(set(own)) < 2:
                continue
            trie = Trie([known[c] for c in numbers[start:end]], sizes[start:end], num, den)
            alone = same_block[start]  # one block meets itself: each asks those before it
            for i in range(end - start):
                if not alone and stored[start + i]:
                    trie.put(i)
            for i in range(end - start):
                if alone or not stored[start + i]:
                    for j in trie.probe(i, own):
                        a, b = numbers[start + i], numbers[start + j]
                        found.add((a, b) if classes[a] < classes[b] else (b, a))
                    if alone:
                        trie.put(i)
        pairs = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
        keep = _close(held["sketch"].tolist(), n, pairs[:, 0], pairs[:, 1], num, den)
        return pd.DataFrame(classes[pairs[keep]], columns=["a", "b"], dtype="int64")

    return rows.groupBy("bucket").applyInPandas(meet, "a long, b long").distinct()


def join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id``, ``stays``: near duplicates by Jaccard similarity of ``n``-word shingles, at least num / den.

    Words are ``[^\\x20\\x09-\\x0D]+``, lower-cased in A-Z. Documents with equal sets are one class. All sets are kept in one global order, by
    hash with frequent shingles last; classes meet in the posting lists of their prefixes, where tries over the ordered prefixes leave
    the pairs whose sketches (a bit per slot: an odd number of shingles) and then whole sets are compared. Before that, each class is compared with a few
    hubs, the least by hash of each of its lists: this links most copies, and classes already connected need not meet again. Lists with the same two least
    classes meet as one, since what shares one shingle often shares many. No pair within ``num / den`` is lost.
    ``component_id`` is the smallest id reachable by links, itself included; ``stays`` marks one text of each component, the first by id, then hash.

    Null, empty and blank texts have empty sets and stand alone; rows that repeat an id stand in every class of their texts; null ids get the
    component's smallest id, or null; an empty table gives none. Other columns are ignored.
    """
    sets = _Sets(docs, n, id_col, text_col)
    flags = frequent_slots(sets)
    by_gram = Window.partitionBy("gram")
    # Dealt by shingle once: what follows groups by it.
    prefixes = materialized(_prefixes(sets, flags, num, den), "prefixes")
    entries = prefixes.select(F.explode("prefix").alias("gram"), "cls", "n").repartition("gram").distinct()
    hubs = [F.min(F.struct(F.xxhash64(F.lit(r), F.col("cls")).alias("o"), F.col("cls"), F.col("n"))).over(by_gram).alias(f"hub{r}") for r in range(HUBS)]
    entries = entries.select("gram", "cls", "n", F.min("cls").over(by_gram).alias("low"), F.max("cls").over(by_gram).alias("high"), *hubs).filter("low < high")
    drawn = F.array_distinct(F.array(*[F.struct(F.col(f"hub{r}.cls").alias("cls"), F.col(f"hub{r}.n").alias("n")) for r in range(HUBS)]))
    shared = materialized(entries.select("gram", "cls", "n", drawn.alias("hubs")), "lists")

    first = shared.select("cls", "n", F.explode("hubs").alias("hub"))
    first = first.filter(F.col("hub.cls") != F.col("cls")).groupBy("cls", "n", "hub.cls", "hub.n").agg(F.count(F.lit(1)).alias("c")).toDF("a", "n", "b", "m", "c")
    # Copies share most of their prefixes, a common passage only little; who is left out here meets in the tries.
    likely = (F.col("c") * 4 >= F.col("n") * (den - num) / den) & (F.least("n", "m") * den >= F.greatest("n", "m") * num)
    best = Window.partitionBy("a").orderBy(F.desc("c"), "b")
    tried = materialized(first.filter(likely).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= 2 * HUBS).select("a", "b"), "pairs")
    links = _linked(sets, _plausible(prefixes, tried, num, den), num, den)
    known = materialized(components(links), "components")

    labelled = shared.select("gram", "cls", "n").join(known, F.col("cls") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cls")).drop("node")
    mixed = labelled.select(
        "*", F.min("cls").over(by_gram).alias("first"), F.min("component").over(by_gram).alias("low"), F.max("component").over(by_gram).alias("high")
    ).filter("low < high")
    mixed = mixed.withColumn("second", F.min(F.when(F.col("cls") > F.col("first"), F.col("cls"))).over(by_gram))
    # Dealt by the two least classes once, like the entries above.
    mixed = mixed.select("first", "second", "cls", "n", "component").repartition("first", "second").distinct()
    lists = materialized(mixed.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("first", "second"))), "lists")
    left = materialized(_candidates(lists, prefixes, flags, num, den), "pairs")
    more = _linked(sets, left, num, den)
    known = components(links.unionByName(more))

    rows = sets.numbers.join(known, F.col("cls") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cls"))
    rows = materialized(rows.select("doc_id", "text_hash", "n_shingles", "component"), "members")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    smallest = rows.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min(place).alias("first"))
    joined = rows.join(smallest, "component", "left")
    return joined.select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.col("component").isNull() | (place == F.col("first"))).alias("stays"),
    )
