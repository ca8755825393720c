"""Toxicity: Levenshtein automata intersected with a lexicon trie, and the context of each hit."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loanloom.llm.common import release, releasing

#: Labelled documents from which lexicon and weights are learned, chosen by hash of the id.
SAMPLE = 20_000
#: Words to either side of a hit that decide whether it is quoted.
CONTEXT = 6
CHUNK = 500_000
MOST_EDITS = 2
#: Share of chance words that the lexicon may hold, on average, and toxic contexts that a word needs to be tested at all.
FALSE_SHARE = 0.05
LEAST_CONTEXTS = 4
#: Least log odds of a term between toxic and other documents: long documents hold more of any word, which makes common words differ a little.
LEAST_ODDS = 2.0
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Terms of one automaton; its states grow faster than its terms.
GROUP = 32
QUOTES = frozenset("\"“”„«»")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Words that announce someone else's words.
REPORTING = {
    "said", "says", "called", "calls", "wrote", "writes", "quote", "quoted", "word", "term", "insult",
    "dit", "mot", "insulte", "appelé", "sagte", "wort", "nannte", "dijo", "palabra", "llamó", "insulto",
}
FEATURES = 4


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@cache
def _blanks() -> np.ndarray:
    return np.array([chr(c).isspace() for c in range(0x110000)])


def edits(term: str) -> int:
    """Edits that still count as a misspelling: none in short terms, two in long ones."""
    return 0 if len(term) < 4 else 1 if len(term) < 8 else MOST_EDITS


@dataclass(frozen=True)
class Automaton:
    """Deterministic automaton that accepts every word within ``edits`` of some term. State 0 is dead, 1 is the start."""

    step: np.ndarray  # state, class of character → state
    classes: dict[int, int]  # code point → class; 0 is any other
    term: np.ndarray  # accepted term of a state, or -1
    distance: np.ndarray
    longest: int

    @staticmethod
    def groups(terms: list[str]) -> tuple[Automaton, ...]:
        """Automata of ``GROUP`` terms each, all over the letters of all terms."""
        letters = sorted({c for t in terms for c in t})
        return tuple(Automaton.of(terms[at : at + GROUP], at, letters) for at in range(0, len(terms), GROUP))

    @staticmethod
    def of(terms: list[str], offset: int = 0, letters: list[str] | None = None) -> Automaton:
        """``offset`` is the number of the first term, ``letters`` the alphabet, if there are more than those of the terms."""
        children: list[dict[str, int]] = [{}]
        ends: dict[int, int] = {}
        for t, term in enumerate(terms):
            node = 0
            for c in term:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                node = children[node][c]
            ends[node] = t
        most = [0] * len(children)  # edits allowed by some term below a node
        for t, term in enumerate(terms):
            node = 0
            for c in ["", *term]:
                node = children[node][c] if c else node
                most[node] = max(most[node], edits(term))
        letters = letters or sorted({c for n in children for c in n})
        classes = {c: i + 1 for i, c in enumerate(letters)}

        def close(found: dict[int, int]) -> frozenset:
            """Trie nodes with the least edits that lead there; leaving out a term's character costs one."""
            stack = list(found.items())
            while stack:
                node, e = stack.pop()
                for child in children[node].values():
                    if e + 1 <= most[child] and e + 1 < found.get(child, 9):
                        found[child] = e + 1
                        stack.append((child, e + 1))
            return frozenset(found.items())

        def after(state: frozenset, c: str) -> frozenset:
            found: dict[int, int] = {}

            def reach(node: int, e: int) -> None:
                if e <= most[node] and e < found.get(node, 9):
                    found[node] = e

            for node, e in state:
                reach(node, e + 1)  # a character too many
                for d, child in children[node].items():
                    reach(child, e + (c != d))
            return close(found)

        states: dict[frozenset, int] = {frozenset(): 0, close({0: 0}): 1}
        queue = list(states)
        step = []
        for state in queue:
            own = sorted({c for node, _ in state for c in children[node]})
            row = [0] * (len(classes) + 1)
            for c in ["", *own]:
                new = after(state, c)
                if new not in states:
                    states[new] = len(states)
                    queue.append(new)
                if c:
                    row[classes[c]] = states[new]
                else:
                    row = [states[new]] * len(row)
            step.append(row)
        term, distance = np.full(len(states), -1), np.zeros(len(states), np.int64)
        for state, i in states.items():
            hits = [(e, ends[n]) for n, e in state if n in ends and e <= edits(terms[ends[n]])]
            if hits:
                distance[i], term[i] = min(hits)
                term[i] += offset
        return Automaton(
            np.array(step, dtype=np.int32), {ord(c): i for c, i in classes.items()}, term, distance, max((len(t) + edits(t) for t in terms), default=0)
        )

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """The class of each code point."""
        table = np.zeros(0x110000, dtype=np.int16)
        table[list(self.classes)] = list(self.classes.values())
        return table[points]

    def run(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """State after each word."""
        state = np.where(lengths <= self.longest, 1, 0).astype(np.int32)
        alive = np.flatnonzero(state)
        for j in range(self.longest):
            alive = alive[(lengths[alive] > j) & (state[alive] > 0)]
            if not len(alive):
                break
            state[alive] = self.step[state[alive], symbols[starts[alive] + j]]
        return state


class Seen:
    """Words that a task has looked up, by hash, with what was found; begins anew beyond ``KEPT`` words."""

    KEPT = 2_000_000

    def __init__(self):
        self.hashes, self.term, self.distance = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int8)

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is there."""
        at = np.searchsorted(self.hashes, hashes)
        return at, (self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes if len(self.hashes) else np.zeros(len(hashes), dtype=bool))

    def add(self, hashes: np.ndarray, term: np.ndarray, distance: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > self.KEPT:
            self.__init__()
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.term, self.distance = (
            np.insert(a, at, b) for a, b in ((self.hashes, hashes), (self.term, term), (self.distance, distance))
        )


@dataclass(frozen=True)
class Hit:
    term: int
    distance: int
    quoted: bool


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces of whole lines: neither words nor contexts cross the end of a line."""
    at = 0
    while len(text) - at > CHUNK:
        cut = text.rfind("\n", at, at + CHUNK) + 1 or text.find("\n", at + CHUNK) + 1 or len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def find_hits(texts: list[str], automata: Automaton | tuple[Automaton, ...], seen: Seen | None = None) -> list[list[Hit]]:
    """Hits of each text in order: words, lower case, that an automaton accepts. Words are runs of letters, and up to three runs with
    one or two other characters between them (``id1ot``, ``st-upid``): more than ``MOST_EDITS`` of those no term allows."""
    automata, seen = automata if isinstance(automata, tuple) else (automata,), seen or Seen()
    out: list[list[Hit]] = [[] for _ in texts]
    if not any(a.longest for a in automata):
        return out
    group: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text.lower()):
            group.append((i, piece))
            size += len(piece)
            if size > CHUNK:
                _hits(group, automata, out, seen)
                group, size = [], 0
    _hits(group, automata, out, seen)
    return out


@cache
def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, dtype=np.uint64)]))


def _word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the code points of each word."""
    powers, back = (_powers(b, 2 * CHUNK) if len(points) < 2 * CHUNK else _powers.__wrapped__(b, len(points)) for b in (_BASE, _INVERSE))
    mixed = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((mixed ^ (mixed >> np.uint64(29))) * powers[: len(points)], dtype=np.uint64)])
    return (total[ends] - total[starts]) * back[starts]


def _accepted(automata: tuple[Automaton, ...], symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, seen: Seen) -> tuple[np.ndarray, np.ndarray]:
    """Nearest term of each word, or -1, and its distance; of equally near ones the first. Every distinct word runs once."""
    short = np.flatnonzero(lengths <= max(a.longest for a in automata))
    term, distance = np.full(len(starts), -1), np.full(len(starts), MOST_EDITS + 1)
    distinct, first, place = np.unique(hashes[short], return_index=True, return_inverse=True)
    starts, lengths = starts[short][first], lengths[short][first]
    at, known = seen.lookup(distinct)
    found, near = np.full(len(distinct), -1), np.full(len(distinct), MOST_EDITS + 1)
    found[known], near[known] = seen.term[at[known]], seen.distance[at[known]]
    new = np.flatnonzero(~known)
    best, least = found[new], near[new]
    for a in automata:
        state = a.run(symbols, starts[new], lengths[new])
        nearer = (a.term[state] >= 0) & (a.distance[state] < least)
        best[nearer], least[nearer] = a.term[state[nearer]], a.distance[state[nearer]]
    found[new], near[new] = best, least
    seen.add(distinct[new], best, least)
    term[short], distance[short] = found[place], near[place]
    return term, distance


def _hits(group: list[tuple[int, str]], automata: tuple[Automaton, ...], out: list[list[Hit]], seen: Seen) -> None:
    joined = "\n\n".join(piece for _, piece in group) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = automata[0].symbols(points)
    edge = np.diff(np.concatenate([[False], _letters()[points], [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # Characters between neighbouring runs, too many where a blank is among them.
    between = starts[1:] - ends[:-1]
    close = np.flatnonzero(between <= MOST_EDITS)
    blank = _blanks()[points]
    between[close[blank[ends[close]] | blank[starts[close + 1] - 1]]] = MOST_EDITS + 1
    found = []
    for runs in range(1, MOST_EDITS + 2):
        at = np.arange(len(starts) - runs + 1) if len(starts) >= runs else np.zeros(0, np.int64)
        if runs > 1:
            at = at[sum(between[j : len(between) - (runs - 2 - j)] for j in range(runs - 1)) <= MOST_EDITS] if len(at) else at
        hashes = _word_hashes(points, starts[at], ends[at + runs - 1]) if len(at) else np.zeros(0, np.uint64)
        term, distance = _accepted(automata, symbols, starts[at], ends[at + runs - 1] - starts[at], hashes, seen)
        found += [(int(distance[k]), runs, int(at[k]), int(term[k])) for k in np.flatnonzero(term >= 0)]
    used: set[int] = set()
    chosen = []
    for distance, runs, w, term in sorted(found):  # a run of letters belongs to one hit, the nearest
        if used.isdisjoint(range(w, w + runs)):
            used.update(range(w, w + runs))
            chosen.append((w, w + runs - 1, term, distance))
    first = np.cumsum([0, *[len(piece) + 2 for _, piece in group]])
    chosen.sort()
    at, till = (np.array([c[k] for c in chosen], dtype=np.int64) for k in (0, 1))
    owners = np.searchsorted(first, starts[at], "right") - 1
    lows = np.maximum(first[owners], starts[np.maximum(0, at - CONTEXT)]).tolist()
    highs = np.minimum(first[owners + 1] - 2, ends[np.minimum(len(ends) - 1, till + CONTEXT)]).tolist()
    for (_, _, term, distance), owner, low, start, end, high in zip(chosen, owners.tolist(), lows, starts[at].tolist(), ends[till].tolist(), highs, strict=True):
        left, right = joined[low:start].rpartition("\n")[2], joined[end:high].partition("\n")[0]
        marks = not QUOTES.isdisjoint(left) and not QUOTES.isdisjoint(right)
        told = not REPORTING.isdisjoint(_LETTERS.findall(left))
        out[group[owner][0]].append(Hit(term, distance, marks or told))


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[str, ...]
    weights: np.ndarray  # log odds of a term
    automata: tuple[Automaton, ...]
    coefficients: np.ndarray

    def features(self, hits: list[Hit]) -> list[float]:
        """Constant; strongest hit; all hits, ever less; what is quoted. A misspelling counts half, a quotation a fifth."""
        parts = [self.weights[h.term] * (0.5 if h.distance else 1.0) * (0.2 if h.quoted else 1.0) for h in hits]
        return [1.0, max(parts, default=0.0), float(np.log1p(sum(parts))), float(np.log1p(sum(h.quoted for h in hits)))]

    def scores(self, texts: list[str], seen: Seen | None = None) -> list[tuple[float, int, str]]:
        found = find_hits(texts, self.automata, seen)
        x = np.array([self.features(h) for h in found]).reshape(len(texts), FEATURES)
        p = 1 / (1 + np.exp(-np.clip(x @ self.coefficients, -30, 30)))
        terms = [",".join(dict.fromkeys(self.terms[h.term] + "~" * bool(h.distance) + "'" * h.quoted for h in hits)) for hits in found]
        return list(zip(p, map(len, found), terms, strict=True))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        penalty = np.diag([1e-3, *[ridge] * (x.shape[1] - 1)])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def _contexts(text: Column) -> Column:
    """Distinct pairs of a text's words, "word before" (words are letters only), as texts: arrays of structs would be compared in pairs."""
    words = _words(text)
    return F.array_distinct(F.zip_with(words, F.concat(F.array(F.lit("")), words), lambda w, before: F.concat(w, F.lit(" "), before)))


def discovered(z: np.ndarray, tested: int, share: float) -> int:
    """How many of the largest ``z`` (in falling order) can be taken if at most ``share`` of those taken may be chance, of ``tested`` words in all: the
    step-up rule of Benjamini and Hochberg on one-sided normal tails."""
    tail = np.array([0.5 * math.erfc(v / math.sqrt(2)) for v in z])
    fine = np.flatnonzero(tail <= share * np.arange(1, len(z) + 1) / max(tested, 1))
    return int(fine[-1]) + 1 if len(fine) else 0


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE, false_share: float = FALSE_SHARE, least_contexts: int = LEAST_CONTEXTS, least_odds: float = LEAST_ODDS,
) -> ToxicityModel:
    """Lexicon and weights from at most ``sample`` labelled documents for which ``usable`` (a condition on ``id``) holds.

    A document with several labels counts as toxic if one says so; null ids, labels and texts take no part. Tested are all words of any length
    in ``least_contexts`` toxic documents; a word counts for no more of them than it has different words before it there, so that copies of one
    document do not make its words toxic. The lexicon holds the words whose log odds between toxic and other documents lie so many standard errors above 0
    that chance words are at most ``false_share`` of them, over all words tested, and are ``least_odds`` or more. Without labels of both kinds every score is the labelled
    share of toxic documents, or 0.
    """
    marked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(F.col("id").isNotNull() & F.col("y").isNotNull() & usable)
        .groupBy("id").agg((F.max("y") > 0).cast("int").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull()).join(F.broadcast(marked), "id").cache()
    n, n1 = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    n0 = n - n1
    if not n1 or not n0:
        rows.unpersist()
        share = (n1 + 1e-9) / (n + 1) if n else 1e-9
        return ToxicityModel((), np.zeros(0), (), np.array([np.log(share / (1 - share)), 0, 0, 0]))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (F.lit(n1 + 1.0) - a) / (b / (F.lit(n0 + 1.0) - b)))
    error = F.sqrt(1 / a + 1 / b + 1 / (F.lit(n1 + 1.0) - a) + 1 / (F.lit(n0 + 1.0) - b))
    words = (
        rows.select("y", F.explode(F.array_distinct(_words(F.col("text")))).alias("word")).filter("word <> ''")
        .groupBy("word").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).filter(F.col("a") >= least_contexts).persist()
    )
    tested = words.count()
    # A word with a smaller z cannot be taken, whatever the number of words tested; contexts can only lower it.
    likely = words.withColumn("z", odds / error).filter("z >= 1.6").drop("z")
    pair = F.split("w", " ")
    used = rows.filter("y = 1").select(F.explode(_contexts(F.col("text"))).alias("w")).distinct().select(F.get(pair, F.lit(0)).alias("word"))
    used = used.join(likely.select("word"), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("contexts"))
    lexicon = likely.join(used, "word").withColumn("a", F.least("a", "contexts")).select("word", odds.alias("odds"), (odds / error).alias("z"))
    lexicon = lexicon.filter("z >= 1.6").orderBy(F.desc("z"), "word").toPandas()
    words.unpersist()
    lexicon = lexicon.head(discovered(lexicon["z"].to_numpy(dtype=float), tested, false_share))
    lexicon = lexicon[lexicon["odds"] >= least_odds]
    names = tuple(lexicon["word"])
    model = ToxicityModel(names, lexicon["odds"].to_numpy(dtype=float), Automaton.groups(list(names)), np.zeros(FEATURES))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Seen()
        for batch in batches:
            x = [model.features(h) for h in find_hits(batch["text"].tolist(), model.automata, seen)]
            yield pd.DataFrame({"y": batch["y"].to_numpy(), "x": x})

    known = rows.select("y", "text").mapInPandas(releasing(measure), "y int, x array<double>").toPandas()
    rows.unpersist()
    return ToxicityModel(names, model.weights, model.automata, _logistic(np.stack(known["x"]), known["y"].to_numpy(dtype=float)))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from ``cut``), ``n_hits`` and ``terms`` (``~`` marks a misspelling, ``'`` a quotation).

    Null and empty texts have no hits and get the score of a text without any. Whole texts count; repeated rows each get a row; an empty table
    stays empty. Columns of the four names are replaced, others pass through.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted", "n_hits", "terms", "_found")]

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        seen = Seen()
        for batch in texts:
            yield pd.DataFrame(model.scores(batch.fillna("").tolist(), seen), columns=["score", "n_hits", "terms"])
        release()

    found = F.pandas_udf(run, "score double, n_hits long, terms string")
    scored = docs.select(*[F.col(f"`{c}`") for c in kept], found(F.col(text_col)).alias("_found"))
    return scored.select(*[F.col(f"`{c}`") for c in kept], "_found.*").withColumn("predicted", (F.col("score") >= cut).cast("int"))
