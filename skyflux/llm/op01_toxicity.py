"""Toxicity of texts behind a noisy-channel deobfuscator.

1. Language model: trigrams of letters (a-z, other letters as one, and a word border) are counted over all texts; 28**3 counts at most.
2. Channel: a suspicious stretch (a word with a digit or sign that may stand for a letter, with a separator before a letter, or with a letter three times or more in a row; or a run of
   three words or more of at most two letters, two of them of one letter) is a lattice: each symbol stands for itself, for letters that it imitates, for nothing (separators, brackets and the like), for a
   word border (separators), or for one more of the letter before it. Viterbi keeps the BEAM best letter strings under language model and channel costs; the READINGS best are the restored words. Stretches
   have any length (the search is linear in it); a symbol, or a symbol and a separator, more than three times in a row stands there three times.
3. Score: words and all words of the reading with most cues are looked up by their stems (their first STEM letters, without case) among cues, stems that are learnt from
   labelled documents. A cue's weight is ln of its rate in toxic over its rate in other documents; other words weigh what is left, a little below 0, and FLOOR at least.
   Documents that agree in their smallest 5-word shingle count once, so copies prove nothing. The score is the logistic of the prior's logit
   and DAMPED times the text's weights, where a cue that comes c times counts log2(1 + c) times.

The fit takes at most LABELLED labelled rows (those with the smallest hashes of doc_id), which bounds the number of cues too. A text's score depends on the model and
its own text alone, not on its neighbours or the file's layout. Labels, lang, source and
doc_id are no inputs of a score. Scoring is one pass without a shuffle. Null and empty texts have the prior alone. Without labels there are no cues
and all scores are 0. Repeated rows stay. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, written
from .text import _LOWER, _SPACE, Words, _words, offsets_and_bytes, shingle_sets, words

#: SUPPORT and FLOOR have the best F1 of SUPPORT 2, 3, 4 and FLOOR -0.01, -0.02, -0.05 in two-fold cross-validation on training rows.
LABELLED, SUPPORT, LEAST, BEAM, READINGS, HELD_OUT, STEM, DAMPED = 50_000, 4, 2.0, 12, 4, 2, 5, 0.5
THRESHOLD, CACHE, CACHED, FLOOR = 0.3, 100_000, 64, -0.01
#: What a symbol may stand for (fixed values).
IMITATES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
SEPARATORS = frozenset("._-*~'`,/ ")
#: Signs that may stand for a letter or for nothing.
LOOSE = frozenset("!(|+")
COST = {"same": 0.0, "imitates": 0.7, "nothing": 1.0, "border": 1.0, "again": 0.4, "twice": 1.5}
_REPEATS = re.compile(r"(.[" + re.escape("".join(sorted(SEPARATORS))) + r"]?)\1{3,}", re.DOTALL)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_BETWEEN = ~_LETTER
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in IMITATES if ord(c) < 128]] = True
_IMITATES = _SIGN.copy()
_SIGN[[ord(c) for c in "._-*~"]] = True
_CODE = np.zeros(256, np.int64)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27
_FOLDED = _LOWER.copy()
_FOLDED[0x80:0xA0] = _LOWER[0xA0:0xC0]  # as capital and small Latin letters differ in UTF-8


def _stems(column: pa.Array) -> Iterator[Words]:
    """As text.words(), but words are runs of letters, and their hashes are their stems'."""
    off, data = offsets_and_bytes(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(off, off[lo] + (1 << 20), "right")) - 1))
        yield _words(lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], _FOLDED, _BETWEEN, STEM)
        lo = hi


def letter_trigrams(docs: DataFrame) -> np.ndarray:
    """ln p(third | first two) of letter classes, add-one smoothed, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(28**3, np.int64)
        for batch in batches:
            off, data = offsets_and_bytes(batch.column(0))
            lo = 0
            while lo < len(off) - 1:
                hi = min(len(off) - 1, max(lo + 1, int(np.searchsorted(off, off[lo] + (1 << 20), "right")) - 1))
                c = np.insert(_CODE[data[off[lo] : off[hi]]], np.repeat(off[lo : hi + 1] - off[lo], 2), 0)  # two borders around each text, so that no trigram has letters of two
                total += np.bincount((c[:-2] * 28 + c[1:-1]) * 28 + c[2:], minlength=28**3) if len(c) > 2 else 0
                lo = hi
        g = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(total[g])], ["g", "c"])

    rows = docs.select("text").mapInArrow(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")).toArrow()
    counts = np.ones(28**3)
    counts[rows.column(0).to_numpy()] += rows.column(1).to_numpy()
    counts = counts.reshape(28, 28, 28)
    return np.log(counts / counts.sum(axis=2, keepdims=True))


def _class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27


def restored(stretch: str, model: np.ndarray | list, beam: int = BEAM, readings: int = READINGS, borders: bool = False) -> list[str]:
    """The best letter strings for a stretch of symbols, by Viterbi over (last two classes, last letter, in a run or not), `beam` of them a step;
    with borders they may be several words, joined by blanks."""
    states: list[tuple] = [(0.0, None, 0, 0, "")]  # cost, letters as (those before, last), last two classes, last letter
    for c in _REPEATS.sub(r"\1\1\1", stretch.lower()):
        letters = ([(c, COST["same"])] if c.isalpha() else []) + [(x, COST["imitates"]) for x in IMITATES.get(c, "")]
        nxt = []
        for cost, text, a, b, last in states:
            for x, more in letters:
                k = _class(x)
                nxt.append((cost + more + (COST["twice"] if x == last else 0.0) - model[a][b][k], (text, x), b, k, x))
                if x == last:
                    nxt.append((cost + more + COST["again"], text, a, b, last))
            if c in SEPARATORS or c in LOOSE or not letters:
                nxt.append((cost + COST["nothing"], text, a, b, last))
            if borders and b and (c in SEPARATORS or c.isspace()):
                nxt.append((cost + COST["border"] - model[a][b][0], (text, " "), b, 0, ""))
        states = heapq.nsmallest(beam, nxt, key=itemgetter(0))
    ends = heapq.nsmallest(readings, ((cost - (model[a][b][0] if b else 0.0), i) for i, (cost, text, a, b, _) in enumerate(states) if text))
    return list(dict.fromkeys(_string(states[i][1]).rstrip() for _, i in ends))


def _string(text: tuple | None) -> str:
    out = []
    while text:
        text, x = text
        out.append(x)
    return "".join(reversed(out))


def suspicious(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end) of the stretches of blank-separated words that the channel may have changed."""
    none = np.zeros(0, np.int64)
    if not len(w.hash):
        return none, none, none
    raw = w.raw
    letter, sign = _LETTER[raw], _SIGN[raw]
    joint = np.ones(len(raw) + 1, bool)  # whether a byte belongs with the one before it
    joint[w.offsets] = False
    joint = joint[1 : len(raw)]
    odd = _IMITATES[raw]
    odd[:-1] |= sign[:-1] & letter[1:] & joint
    low = _CODE[raw]
    odd[2:] |= (low[2:] == low[1:-1]) & (low[2:] == low[:-2]) & (low[2:] > 0) & (low[2:] < 27) & joint[1:] & joint[:-1]
    euro = (raw[:-2] == 0xE2) & (raw[1:-1] == 0x82) & (raw[2:] == 0xAC)
    odd[:-2] |= euro
    has_odd = np.add.reduceat(odd.astype(np.int32), w.start) > 0
    size = w.end - w.start
    letters = np.add.reduceat(letter.astype(np.int32), w.start)
    row = np.repeat(np.arange(len(w.doc) - 1), np.diff(w.doc))
    words_at = np.flatnonzero(has_odd)
    short = ((size <= 2) & (letters == size)) | ((size == 1) & _SIGN[raw[w.start]])
    linked = short[1:] & short[:-1] & (row[1:] == row[:-1])
    first = np.flatnonzero(short & ~np.concatenate([[False], linked]))
    last = np.flatnonzero(short & ~np.concatenate([linked, [False]]))
    ones = np.concatenate([[0], np.cumsum(size == 1)])
    long = (last - first >= 2) & (ones[last + 1] - ones[first] >= 2)
    first, last = first[long], last[long]
    return np.concatenate([row[words_at], row[first]]), np.concatenate([w.start[words_at], w.start[first]]), np.concatenate([w.end[words_at], w.end[last]])


class Model:
    """Language model, cues (a stem's hash: its weight), the weight of any word, and the prior's logit."""

    def __init__(self, trigrams: np.ndarray, cues: dict[int, float], every: float, prior: float):
        self.trigrams, self.every, self.prior = trigrams, every, prior
        self._nested = trigrams.tolist()  # quicker to look up one by one
        self._cache: dict[str, list[tuple[int, str]]] = {}
        self.stems = np.sort(np.array(list(cues), np.int64).view(np.uint64))
        self.weights = np.array([cues[int(x)] for x in self.stems.view(np.int64)])
        self._bits = np.zeros(1 << 16, bool)
        self._bits[(self.stems & np.uint64(0xFFFF)).astype(np.int64)] = True

    def cues_in(self, stretch: str) -> list[tuple[int, str]]:
        """(cue, word) of the cues in the reading that has most."""
        got = self._cache.get(stretch)
        if got is not None:
            return got
        if len(self._cache) >= CACHE:
            self._cache.clear()
        got = []
        for x in _stems(pa.array(restored(stretch, self._nested, borders=True), pa.string())):
            i, k = self.found(x.hash)
            of = np.searchsorted(x.doc, i, "right") - 1
            for t in np.unique(of):
                mine = np.flatnonzero(of == t)
                if len(mine) > len(got):
                    got = [(int(k[j]), x.raw[x.start[i[j]] : x.end[i[j]]].tobytes().decode("utf-8", "replace")) for j in mine]
        if len(stretch) <= CACHED:  # longer ones hardly recur
            self._cache[stretch] = got
        return got

    def found(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, cue) of the stems that are cues."""
        if not len(self.stems):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self._bits[(h & np.uint64(0xFFFF)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.stems, h[at]), len(self.stems) - 1)
        ok = self.stems[k] == h[at]
        return at[ok], k[ok]

    def score(self, column: pa.Array) -> tuple[np.ndarray, list[list[str]]]:
        """Scores of texts, and the restored cues that counted."""
        logit = np.full(len(column), self.prior)
        seen: list[list[str]] = [[] for _ in range(len(column))]
        if not len(self.stems):
            return np.zeros(len(column)), seen
        for w in _stems(column):
            at, cue = self.found(w.hash)
            row = np.searchsorted(w.doc, at, "right") - 1
            plain = Words(w.lo, w.hi, w.raw, *_word_borders(w), w.hash, w.offsets)
            more: list[tuple[int, int]] = []
            for r, a, b in zip(*suspicious(plain), strict=True):
                best = self.cues_in(w.raw[a:b].tobytes().decode("utf-8", "replace"))
                if best:
                    known = cue[np.searchsorted(w.start[at], a) : np.searchsorted(w.start[at], b)].tolist()  # these are counted as they stand
                    for k, word in best:
                        if k in known:
                            known.remove(k)
                        else:
                            more.append((int(r), k))
                            seen[w.lo + int(r)].append(word)
            row = np.concatenate([row, np.array([x[0] for x in more], np.int64)])
            cue = np.concatenate([cue, np.array([x[1] for x in more], np.int64)])
            pair, count = np.unique(row * len(self.stems) + cue, return_counts=True)
            np.add.at(logit, w.lo + pair // len(self.stems), DAMPED * self.weights[pair % len(self.stems)] * np.log2(1 + count))
            logit[w.lo : w.hi] += DAMPED * self.every * np.diff(w.doc)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500))), seen


def _word_borders(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row borders of the blank-separated words of a chunk."""
    edge = np.zeros(len(w.raw) + 1, bool)
    edge[w.offsets] = True
    full = ~_SPACE[w.raw]
    first, last = full.copy(), full.copy()
    first[1:] &= ~full[:-1] | edge[1:-1]
    last[:-1] &= ~full[1:] | edge[1:-1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, w.offsets)


def _evidence(rows: DataFrame) -> DataFrame:
    """stem, toxic (0/1), group (the smallest shingle) and count in a labelled text; stem null: all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, out = batch.column(1).to_numpy(), []
            plain = [s[0] if len(s) else np.uint64(0) for w in words(batch.column(0), lower=True) for s in shingle_sets(w)]
            for w in _stems(batch.column(0)):
                for r in range(w.hi - w.lo):
                    h, n = np.unique(w.hash[w.doc[r] : w.doc[r + 1]], return_counts=True)
                    none = np.concatenate([np.zeros(len(h), bool), [True]])
                    out.append(pa.RecordBatch.from_arrays([pa.array(np.concatenate([h, [np.uint64(0)]]).view(np.int64), mask=none), pa.array(np.full(len(h) + 1, toxic[w.lo + r], np.int32)), pa.array(np.full(len(h) + 1, plain[w.lo + r]).view(np.int64)), pa.array(np.concatenate([n, [n.sum()]]).astype(np.int64))], ["stem", "toxic", "group", "n"]))
            yield from out

    return rows.mapInArrow(run, "stem long, toxic int, group long, n long")


def trained(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, support: int = SUPPORT, floor: float = FLOOR) -> Model:
    """labels: doc_id and toxic (0/1)."""
    chosen = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "toxic").limit(labelled)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    once = _evidence(rows).groupBy("stem", "group").agg(F.max("toxic").alias("toxic"), F.max("n").alias("n"))
    sides = [F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)).alias(name) for t, name in ((1, "yes"), (0, "no"))]
    proof = written(once.groupBy("stem").agg(*sides, F.sum("toxic").alias("groups"), F.count("*").alias("all")), "stems")
    total = proof.where("stem IS NULL").first()
    trigrams = letter_trigrams(docs)
    if total is None or not total["groups"] or total["groups"] == total["all"] or not total["yes"] or not total["no"]:
        return Model(trigrams, {}, 0.0, 0.0)
    weight = F.ln((F.col("yes") + 0.5) / float(total["yes"])) - F.ln((F.col("no") + 0.5) / float(total["no"]))
    sure = weight - 1 / F.sqrt(F.col("groups"))  # what few documents show counts less
    found = proof.where("stem IS NOT NULL").withColumn("weight", sure).where((F.col("groups") >= support) & (F.col("weight") >= LEAST)).orderBy("stem").collect()
    dropped(proof)
    left = [1 - sum(r[x] for r in found) / total[x] for x in ("yes", "no")]
    share = total["groups"] / total["all"]
    return Model(trigrams, {r["stem"]: r["weight"] for r in found}, max(floor, float(np.log(max(left[0], 1e-9) / left[1]))), float(np.log(share / (1 - share))))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, seen = shared.value.score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(seen, pa.list_(pa.string()))], ["doc_id", "score", "predicted", "restored"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, restored array<string>")


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = trained(docs, labels.where(part != HELD_OUT))
    return scored(docs, model).withColumn("held_out", F.coalesce(part == HELD_OUT, F.lit(False))).select("doc_id", "held_out", "score", "predicted", "restored")
