"""Toxicity by a weighted lexicon (operator 1).

A text is folded character by character (case, homoglyphs, digit and sign
substitutions), one Aho-Corasick automaton finds every lexicon term in one pass,
terms inside an exception phrase do not count, and the sum of weights is divided
by a root of the length.  A monotone calibration on labelled rows turns that
into a score from 0 to 1.

The lexicon is learnt from labelled rows: whole words and word stems whose
log-odds for label 1 are high.  Support counts distinct neighbourhoods (the word
before and after), so a hundred copies of one text count as one occurrence.
Phrases of a term with a neighbour that are seen only in clean rows become
exceptions.  Learning uses at most `max_rows` labelled rows, those smallest by a
hash of the key; scoring runs over all rows.

Defined cases: null and empty text score as a text without terms; a null key is
carried and never held out; repeated rows are each scored; unlabelled or
null-labelled rows teach nothing; several labels of one key count as their
maximum; with no labelled row of either class the lexicon is empty and every
score is 0.  Only the named key and text columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.session import stage

# Look-alike letters, and digits and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m", "т": "t", "н": "h", "в": "b",
    "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v", "κ": "k", "ı": "i", "ɡ": "g", "ɑ": "a",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}

_PUNCTUATION = "!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~\t\n\r\x0b\x0c"
_FULL_WIDTH = {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
_TABLE = str.maketrans(HOMOGLYPHS | SUBSTITUTES | _FULL_WIDTH | dict.fromkeys(_PUNCTUATION, " ") | {"$": " ", "@": " "})
_SIGN = re.compile(r"(?<=[^\W\d_])[$@](?=[^\W\d_])")
_INVISIBLE = re.compile("[\xad\u200b-\u200f\u2060\ufeff]")
STEMS = range(4, 8)


def fold(text: str | None) -> str:
    """The text in plain lower-case letters; signs between words become spaces.
    One character stays one character, but for invisible ones, which go."""
    t = text or ""
    if not t.isascii():
        t = _INVISIBLE.sub("", t)
    if "$" in t or "@" in t:
        t = _SIGN.sub(lambda m: "s" if m[0] == "$" else "a", t)
    low = t.lower()
    return low.translate(_TABLE)


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights (`stem*` is any word that starts so), exception phrases,
    and the calibration as (lower bound of the density, score) steps."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    steps: tuple[tuple[float, float], ...] = ()
    length_power: float = 0.25


class Matcher:
    """The automaton of a lexicon; made once per task."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        keys: dict[str, list] = {}
        for term, w in lexicon.terms.items():
            keys.setdefault(" " + term.rstrip("*"), []).append((w, term.endswith("*"), False))
        for phrase in lexicon.exceptions:
            keys.setdefault(" " + phrase, []).append((0.0, False, True))
        for k, v in keys.items():
            self.automaton.add_word(k, (len(k), v))
        if keys:
            self.automaton.make_automaton()
        self.empty = not keys

    def matches(self, folded: str) -> dict[int, float]:
        """Start of each matched word in the folded text, and the largest weight there."""
        if self.empty:
            return {}
        text = f" {folded} "
        found: dict[int, float] = {}
        covered = []
        for end, (size, kinds) in self.automaton.iter(text):
            start = end - size + 1
            for w, stem, exception in kinds:
                if not stem and text[end + 1].isalnum():
                    continue
                if exception:
                    covered.append((start, end))
                elif w > found.get(start, 0.0):
                    found[start] = w
        if covered and found:
            found = {s: w for s, w in found.items() if not any(a <= s <= b for a, b in covered)}
        return found

    def density(self, folded: str) -> float:
        total = sum(self.matches(folded).values())
        return total / (1 + folded.count(" ")) ** self.lexicon.length_power if total else 0.0

    def score(self, density: float) -> float:
        out = 0.0
        for low, s in self.lexicon.steps:
            if density < low:
                break
            out = s
        # within a step the density still orders the rows
        return min(1.0, max(0.0, 0.999 * out + 0.001 * density / (1 + density)))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_rows: int) -> DataFrame:
    """At most `max_rows` labelled rows outside the held-out fold, as (k, t, y)."""
    fold_of = F.crc32(F.col(key).cast("string")) % 4
    known = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(label).alias("y"))
             .filter(F.crc32(F.col("k").cast("string")) % 4 != 2).orderBy(F.xxhash64("k"), "k").limit(max_rows))
    rows = docs.filter(fold_of != 2).select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # bounded by max_rows pairs of numbers
    return rows.join(F.broadcast(known), "k")


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of either label that hold a word or stem, summed over the task."""
    both: tuple[Counter, Counter] = (Counter(), Counter())

    def rows() -> pd.DataFrame:
        terms = list(both[0].keys() | both[1].keys())
        # typed columns: a task without rows has no value to show the type
        out = pd.DataFrame({"term": pd.Series(terms, dtype="object"), "neg": pd.Series([both[0][x] for x in terms], dtype="int64"), "pos": pd.Series([both[1][x] for x in terms], dtype="int64")})
        both[0].clear()
        both[1].clear()
        return out

    for b in batches:
        for t, y in zip(b["t"], b["y"], strict=True):
            words = {w for w in fold(t).split() if 4 <= len(w) <= 24}
            terms = words | {f"{w[:n]}*" for w in words for n in STEMS if n < len(w)}
            both[1 if y else 0].update(terms)
            if len(both[0]) + len(both[1]) > 300_000:
                yield rows()
    yield rows()


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", *,
          max_rows: int = 40_000, max_terms: int = 2_000, min_support: int = 6, min_weight: float = 2.5, length_power: float = 0.25) -> Lexicon:
    """Lexicon, exceptions and calibration from the labelled rows."""
    rows = stage(labelled(docs, labels, key, text, label, max_rows))
    calibrating = F.crc32(F.col("k").cast("string")) % 4 == 3
    train = rows.filter(~calibrating).select("t", "y")
    sizes = {bool(r["y"]): r["n"] for r in train.groupBy((F.col("y") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(True, 0), sizes.get(False, 0)
    if not pos or not neg:
        return Lexicon(length_power=length_power)
    odds = F.log((F.col("pos") + 0.5) / (pos + 1.0)) - F.log((F.col("neg") + 0.5) / (neg + 1.0))
    counted = train.mapInPandas(_term_counts, "term string, neg long, pos long").groupBy("term").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    # the lexicon's size is a parameter, not a function of the corpus
    candidates = [r["term"] for r in counted.filter((F.col("pos") >= min_support) & (odds >= min_weight)).orderBy(F.desc("pos"), "term").limit(max_terms).collect()]
    if not candidates:
        return Lexicon(length_power=length_power)
    hood = Lexicon(dict.fromkeys(candidates, 1.0))

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick
        a = ahocorasick.Automaton()
        for t in hood.terms:
            a.add_word(" " + t.rstrip("*"), None) if " " + t.rstrip("*") not in a else None
        for t in {t.rstrip("*") for t in hood.terms}:
            a.add_word(" " + t, t)
        a.make_automaton()
        for b in batches:
            out = []
            for t, y in zip(b["t"], b["y"], strict=True):
                f = f" {fold(t)} "
                for end, t0 in a.iter(f):
                    stop = f.find(" ", end + 1)
                    stop = len(f) if stop < 0 else stop
                    word, before, after = f[end - len(t0) + 1:stop], f[max(0, end - 60):end - len(t0) + 1].split()[-1:], f[stop:stop + 40].split()[:1]
                    for term in ((t0, f"{t0}*") if word == t0 else (f"{t0}*",)):
                        if term in hood.terms:
                            out.append((term, word, " ".join(before), " ".join(after), int(y > 0)))
            yield pd.DataFrame(out, columns=["term", "word", "before", "after", "y"]).drop_duplicates()

    seen = train.mapInPandas(neighbours, "term string, word string, before string, after string, y int").distinct()
    support = (seen.groupBy("term").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"), F.countDistinct("before").alias("hoods"))
               .filter((F.col("pos") >= min_support) & (F.col("hoods") >= min_support)))
    support = support.select("term", "pos", odds.alias("w")).filter(F.col("w") >= min_weight)
    terms = _narrow({r["term"]: (float(r["w"]), r["pos"]) for r in support.collect()})  # at most max_terms
    phrases = seen.select("y", F.explode(F.array(F.concat_ws(" ", "before", "word"), F.concat_ws(" ", "word", "after"))).alias("p")).filter(F.col("p").contains(" "))
    exceptions = (phrases.groupBy("p").agg(F.sum("y").alias("pos"), F.count("*").alias("n")).filter((F.col("pos") == 0) & (F.col("n") >= min_support))
                  .orderBy(F.desc("n"), "p").limit(max_terms))
    lexicon = Lexicon(terms, frozenset(r["p"] for r in exceptions.collect()), (), length_power)
    calibration = rows.filter(calibrating).select("t", "y").mapInPandas(lambda it: _densities(it, lexicon), "bin long, y int")
    bins = calibration.groupBy("bin").agg(F.sum("y").alias("pos"), F.count("*").alias("n")).orderBy("bin").collect()  # a few hundred bins
    return Lexicon(terms, lexicon.exceptions, _isotonic([(r["bin"], r["pos"], r["n"]) for r in bins]), length_power)


def _narrow(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Without stems whose support comes from one longer stem or word alone (too
    general), and without longer terms that a stem covers (nothing new)."""
    def under(stem: str) -> list[str]:
        return [t for t in found if t != stem and t.rstrip("*").startswith(stem[:-1])]
    general = {s for s in found if s.endswith("*") and any(found[t][1] >= 0.95 * found[s][1] for t in under(s))}
    kept = {t for t in found if t not in general}
    covered = {t for s in kept if s.endswith("*") for t in under(s)}
    return {t: found[t][0] for t in kept - covered}


_BINS = 16  # bins a doubling of the density


def _densities(batches: Iterator[pd.DataFrame], lexicon: Lexicon) -> Iterator[pd.DataFrame]:
    m = Matcher(lexicon)
    for b in batches:
        d = [m.density(fold(t)) for t in b["t"]]
        yield pd.DataFrame({"bin": [-1000 if x <= 0 else max(-999, min(999, math.floor(_BINS * math.log2(x)))) for x in d], "y": (b["y"] > 0).astype("int32")})


def _isotonic(bins: list[tuple[int, int, int]]) -> tuple[tuple[float, float], ...]:
    """Pooled adjacent violators: label rates that never fall with the density.  A
    density between two bins that were seen takes the upper one's rate."""
    pools: list[list[float]] = []  # bin before the pool's first, rows with label 1, rows
    before = None
    for b, pos, n in bins:
        pools.append([before, pos, n])
        before = b
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, p, m = pools.pop()
            pools[-1][1] += p
            pools[-1][2] += m
    low = lambda b: 0.0 if b is None else 1e-300 if b <= -1000 else 2.0 ** ((b + 1) / _BINS)
    return tuple((low(b), (p + 0.1) / (n + 0.2)) for b, p, n in pools)


def score(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Key, held-out flag, score, decision, number of matched words, for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(lexicon)
        for b in batches:
            scores, hits = [], []
            for t in b.column("t").to_pylist():
                folded = fold(t)
                found = m.matches(folded)
                d = sum(found.values()) / (1 + folded.count(" ")) ** lexicon.length_power if found else 0.0
                scores.append(m.score(d))
                hits.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(hits, pa.int32())],
                names=["k", "held_out", "score", "predicted", "n_terms"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    out = rows.mapInArrow(run, f"k {kind}, held_out boolean, score double, predicted int, n_terms int")
    return out.withColumnRenamed("k", key)


def spans(text: str | None, lexicon: Lexicon) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the matched words in the folded text."""
    folded = fold(text)
    out = []
    for s, w in sorted(Matcher(lexicon).matches(folded).items()):
        e = folded.find(" ", s)
        out.append((s, len(folded) if e < 0 else e, w))
    return out


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents whose score stays under the threshold, all columns kept.
    The decision is made in one pass over the rows, so repeated keys are safe."""
    lexicon = learn(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(lexicon)
        for b in batches:
            keep = [m.score(m.density(fold(t))) < threshold for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
