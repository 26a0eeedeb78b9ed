"""Toxicity of restored text: noisy-channel deobfuscation, then a word model.

Disguised words are restored by Viterbi decoding.  A token opens a lattice with one or more readings for each of
its characters: itself, the letter that it stands for in leetspeak, nothing (a filler between letters), or, for a
repeated letter, a merge into its predecessor.  In a run of single letters, of any length, a blank is read as nothing
(spacing) or as the end of a word; words of the lexicon are cheaper paths than their letters.  The path that a
character language model and the channel's costs like best is the restored word or words.  A token with one path
(letters only, none twice in a row unless it is a word of the lexicon, not one letter alone) is its own decoding, so
that nearly all tokens cost a look-up.

The character model and a lexicon of frequent words, which decides between two readings of a token's edges, are
learned from all training documents.  The word model is naive Bayes over the
presence of restored words and of their stems of four and five letters, over features that differ clearly between
the classes, calibrated on training rows.  Both are bounded tables.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telequal.session import broadcast_if_small, durable

#: Letters that a character stands for in leetspeak.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e",
}
FILLERS = "*.-_~'`^:,;/\\#%&?"
COST_LEET, COST_FILLER, COST_MERGE, COST_JOIN = 1.0, 1.5, 0.7, 0.5
#: A word of the lexicon costs this share of its letters' cost in a spaced run.
KNOWN = 0.5
FEATURES = 4_000
BIGRAMS = 4_000
LEXICON = 20_000
_SIMPLE = re.compile(r"[^\W\d_]{2,}\Z")
_TRIPLE = re.compile(r"(.)\1\1")
_DOUBLE = re.compile(r"(.)\1")
_BLANKS = re.compile(r"\s+")
_MARKS = ".,;:!?-_*"
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_MEMO = 1_000_000


class CharModel:
    """Bigram model of word characters with a floor; ``pairs`` maps (before, after) to counts."""

    def __init__(self, pairs: dict[str, int], lexicon: Iterable[str] = ()) -> None:
        self.lexicon = frozenset(lexicon)
        total: dict[str, int] = {}
        for p, n in pairs.items():
            total[p[0]] = total.get(p[0], 0) + n
        self.log = {p: math.log((n + 0.5) / (total[p[0]] + 50)) for p, n in pairs.items()}
        self.floor = {c: math.log(0.5 / (n + 50)) for c, n in total.items()}

    def step(self, before: str, after: str) -> float:
        return self.log.get(before + after, self.floor.get(before, -6.0))


def readings(token: str) -> list[list[tuple[str, float]]]:
    """For each character its readings with their costs."""
    out = []
    for i, c in enumerate(token):
        own = [(c, 0.0 if c.isalpha() else 3.0)]
        own += [(x, COST_LEET) for x in LEET.get(c, "")]
        if not c.isalnum():
            own.append(("", COST_FILLER if c in FILLERS or c in LEET else 2.0))
        if i and c == token[i - 1]:
            own.append(("", COST_MERGE))
        out.append(own)
    return out


def decode(token: str, model: CharModel) -> str:
    """The cheapest path through the token's lattice."""
    best: dict[str, tuple[float, str]] = {" ": (0.0, "")}
    for own in readings(token):
        nxt: dict[str, tuple[float, str]] = {}
        for last, (cost, word) in best.items():
            for c, extra in own:
                if c:
                    new = (cost + extra - model.step(last, c), word + c)
                    key = c
                else:
                    new = (cost + extra, word)
                    key = last
                if key not in nxt or new < nxt[key]:
                    nxt[key] = new
        best = nxt
    return min((cost - model.step(last, " "), word) for last, (cost, word) in best.items())[1]


class Restorer:
    """Words of a text after restoration, lower-cased, without punctuation around them."""

    def __init__(self, model: CharModel) -> None:
        self.model = model
        self.memo: dict[str, str] = {}
        self.trie: dict | None = None

    def token(self, raw: str) -> str:
        got = self.memo.get(raw)
        if got is None:
            word = _EDGE.sub("", raw)
            if not word:
                got = ""
            elif _SIMPLE.match(word) and not _TRIPLE.search(word) and (word == raw or not any(c in LEET for c in raw)):
                got = word
                if _DOUBLE.search(word) and word not in self.model.lexicon:
                    # A letter written twice is merged only if that makes a word of the lexicon.
                    tried = {decode(word, self.model), _DOUBLE.sub(r"\1", word)} & self.model.lexicon
                    got = min(((self.cost(w), w) for w in tried), default=(0.0, word))[1]
            else:
                # Marks around a word are decoded with it where they may be letters ($cum), else they are cut off.
                # Of these, a word of the lexicon wins, then the likelier one.
                bare = raw.strip(".,;:?\"'()")
                shapes = [word, bare, *[c + bare[1:] for c in LEET.get(bare[:1], "")]]
                tried = {decode(x, self.model) for x in shapes} - {""}
                got = min(((w not in self.model.lexicon, self.cost(w), w) for w in tried), default=(True, 0.0, ""))[2]
                got = _EDGE.sub("", got)
            if got != word and len(self.memo) < _MEMO:
                self.memo[raw] = got  # words that stay as they are need no memory
        return got

    def cost(self, word: str) -> float:
        path = f" {word} "
        return -sum(self.model.step(a, b) for a, b in zip(path, path[1:])) / (len(word) + 1)

    def words(self, text: str) -> set[str]:
        """Distinct restored words; runs of single characters count as the words they are spaced from as well."""
        out = {self.token(t) for t in self.raw(text)}
        out.discard("")
        return out

    def raw(self, text: str) -> set[str]:
        """Distinct lower-cased tokens, and the words that runs of single characters are decoded to."""
        text = text.lower()
        tokens = text.split()
        out = set(tokens)
        runs = spaced(tokens)
        if runs:
            gaps = [m.group() for m in _BLANKS.finditer(text.strip())]
            for a, b in runs:
                out.update(self.run([t.strip(_MARKS) for t in tokens[a:b]], [len(g) > 1 for g in gaps[a : b - 1]]))
        return out

    def run(self, letters: list[str], wide: list[bool]) -> list[str]:
        """Words of the cheapest path through a run of single characters; a wide blank is an end of a word."""
        if self.trie is None:
            self.trie = {}
            for w in self.model.lexicon:
                node = self.trie
                for c in w:
                    node = node.setdefault(c, {})
                node[""] = self.cost(w) * (len(w) + 1) * KNOWN
        n, step = len(letters), self.model.step
        own = readings("".join(letters))
        # By place: the cheapest way to have ended a word there, as (cost, last word as linked letters, place before it).
        ended: list[tuple | None] = [(0.0, None, 0)] + [None] * n
        known: list[list[tuple]] = [[] for _ in range(n + 1)]  # ends of lexicon words
        open_: dict[str, tuple] = {}  # words going on, by last letter: cost, letters, where they began
        for i in range(n):
            start = ended[i]
            if start is not None:
                for end, cost, word in self._known(own, wide, i):
                    known[end].append((start[0] + cost, (None, word), i))
            joined = i and not wide[i - 1]
            nxt: dict[str, tuple] = {}
            for last, (cost, said, began) in open_.items() if joined else ():
                for c, extra in own[i]:
                    new = cost + COST_JOIN + extra - (step(last, c) if c else 0.0)
                    if c or extra:
                        key = c or last
                        if key not in nxt or new < nxt[key][0]:
                            nxt[key] = (new, (said, c) if c else said, began)
            if start is not None:
                for c, extra in own[i]:
                    new = start[0] + extra - step(" ", c) if c else 0.0
                    if c and (c not in nxt or new < nxt[c][0]):
                        nxt[c] = (new, (None, c), i)
            open_ = nxt
            ways = [*known[i + 1], *[(cost - step(last, " "), said, began) for last, (cost, said, began) in open_.items()]]
            ended[i + 1] = min(ways, key=lambda x: x[0], default=None)
        out, at = [], n
        while at:
            _, said, at = ended[at]
            word = []
            while said:
                said, c = said
                word.append(c)
            out.append("".join(reversed(word)))
        return out

    def _known(self, own, wide: list[bool], i: int):
        """(end, cost, word) of the lexicon words that the run holds from place ``i`` on."""
        here = [(self.trie, 0.0, "")]
        for j in range(i, len(own)):
            if not here or (j > i and wide[j - 1]):
                return
            there: dict[str, tuple] = {}
            for node, cost, word in here:
                for c, extra in own[j]:
                    to = node.get(c) if c else node
                    if to is not None and (c or word):
                        new = (to, cost + extra + (COST_JOIN if j > i else 0.0), word + c)
                        if new[2] not in there or new[1] < there[new[2]][1]:
                            there[new[2]] = new
            here = list(there.values())
            for node, cost, word in here:
                if "" in node:
                    yield j + 1, cost + node[""], word


def spaced(tokens: list[str]) -> list[tuple[int, int]]:
    """Runs of 3 and more single characters, each perhaps with a mark, as (first, end)."""
    short = [i for i, t in enumerate(tokens) if len(t) <= 2 and len(t.strip(_MARKS)) == 1]
    out, k = [], 0
    while k < len(short):
        j = k + 1
        while j < len(short) and short[j] == short[j - 1] + 1:
            j += 1
        if j - k >= 3:
            out.append((short[k], short[j - 1] + 1))
        k = j
    return out


def features(word: str) -> tuple[str, ...]:
    """A word and its stems."""
    return (word, *[word[:n] + "*" for n in (4, 5) if len(word) > n]) if word else ()


def in_fold(fold: int, of: int):
    """Rows whose crc32 of the id as text leaves this remainder."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == fold


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text`` and ``toxic`` of every document that ``labels`` marks; labels go to all executors only while they are few."""
    chosen = broadcast_if_small(_marks(labels))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id").drop("doc_id")


def _marks(labels: DataFrame) -> DataFrame:
    return labels.dropna(subset=["doc_id", "toxic"]).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _learned(train: DataFrame) -> dict:
    """Character pairs, lexicon and feature weights from all rows of ``train``; not calibrated."""
    letters = F.explode(F.split(F.lower("text"), "[^\\p{L}]+")).alias("w")
    words = durable(train.select(letters).where("w != ''").groupBy("w").count())
    lexicon = [r["w"] for r in words.where("length(w) > 2").orderBy(F.desc("count"), "w").limit(LEXICON).collect()]
    pairs = (
        words.select(F.explode(F.transform(F.sequence(F.lit(0), F.length("w")), lambda i: F.substr(F.concat(F.lit(" "), "w", F.lit(" ")), i + 1, F.lit(2)))).alias("p"), "count")
        .groupBy("p").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "p").limit(BIGRAMS)
    )
    chars = {r["p"]: r["n"] for r in pairs.collect()}  # at most BIGRAMS rows

    def held(batches):
        restore = Restorer(CharModel(chars, lexicon))
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            seen = Counter(), Counter()
            for t, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found: set[str] = set()
                for x in restore.raw(t):
                    got = known.get(x)
                    if got is None:
                        if len(known) >= _MEMO:
                            known.clear()
                        known[x] = got = features(restore.token(x))
                    found.update(got)
                seen[bool(y)].update(found)
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array([c[f] for f in names], pa.int64()) for c in seen]],
                names=["f", "clean", "toxic"],
            )

    classes = {bool(r["toxic"]): r["count"] for r in train.groupBy("toxic").count().collect()}
    n0, n1 = classes.get(False, 0), classes.get(True, 0)
    counts = train.mapInArrow(held, "f string, clean long, toxic long").groupBy("f").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    # Features of toxic rows whose rate is far above that of clean rows, with a margin for chance.
    rate1 = (F.col("toxic") - F.sqrt("toxic")) / max(n1, 1)
    rate0 = (F.col("clean") + F.sqrt("clean") + 1) / max(n0, 1)
    best = (
        counts.where("toxic >= 3").withColumn("lift", F.log(rate1 / rate0)).where("lift > 1")
        .orderBy(F.desc(F.col("lift") * F.sqrt("toxic")), "f").limit(FEATURES)
    )
    weights = {r["f"]: r["lift"] for r in best.collect()}  # at most FEATURES rows
    return {"chars": chars, "lexicon": lexicon, "weights": weights, "n": (n0, n1), "slope": 1.0, "base": 0.0}


def _calibrate(model: dict, judged: DataFrame) -> dict:
    """The model with the line through the raw scores (``raw``) of all training rows (``toxic``)."""
    if all(model["n"]):
        totals = judged.groupBy(F.round("raw", 1).alias("s")).agg(
            F.count("*").alias("n"), F.sum(F.col("toxic").cast("int")).alias("y")
        ).collect()  # few rounded values
        model["slope"], model["base"] = _calibrated([(r["s"], r["n"], r["y"]) for r in totals])
    return model


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Character pairs, feature weights and calibration, from every labelled document.

    Without both classes every text gets the share of toxic rows (0 without any) as its score."""
    train = durable(_training(docs, labels))
    model = _learned(train)
    return _calibrate(model, train.mapInArrow(_scorer(model, ["toxic"]), f"toxic {train.schema['toxic'].dataType.simpleString()}, raw double"))


def fit_and_score(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """What ``scored(docs, fit(docs, labels), carry)`` gives, with each text read once less: training rows are
    calibrated by the raw scores that the result is made of."""
    model = _learned(durable(_training(docs, labels)))
    names = [c for c in (docs.columns if carry is None else carry) if c != "score"]
    raw = durable(_raw(docs.select(*[F.col(c).alias(f"_{c}") for c in names], "doc_id", "text"), model, [*[f"_{c}" for c in names], "doc_id"]))
    model = _calibrate(model, raw.join(_marks(labels), "doc_id"))
    return raw.select(*[F.col(f"_{c}").alias(c) for c in names], _probability(model).alias("score"))


def _calibrated(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic line through the raw scores, by damped Newton steps."""
    s, n, y = (np.array(x, float) for x in zip(*points))
    a, b = 0.1, -2.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
        w = n * p * (1 - p)
        g = np.array([((y - n * p) * s).sum() - 0.01 * a, (y - n * p).sum() - 0.01 * b])
        h = np.array([[(w * s * s).sum() + 0.01, (w * s).sum()], [(w * s).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / np.abs(step).max())
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def _scorer(model: dict, names: list[str]):
    """Task function: the columns ``names`` and the sum of the weights of the features that a text has, ``raw``."""

    def run(batches):
        restore = Restorer(CharModel(model["chars"], model["lexicon"]))
        weights = model["weights"]
        known: dict[str, tuple[str, ...]] = {}

        def hits(token: str) -> tuple[str, ...]:
            if len(known) >= _MEMO:
                known.clear()
            known[token] = out = tuple(f for f in features(restore.token(token)) if f in weights)
            return out

        for batch in batches:
            scores = []
            for t in batch.column("text").to_pylist():
                found: set[str] = set()
                for x in restore.raw(t or ""):
                    got = known.get(x)
                    if got is None:
                        got = hits(x)
                    if got:
                        found.update(got)
                scores.append(float(sum(sorted(weights[f] for f in found))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(scores, pa.float64())], names=[*names, "raw"])

    return run


def _raw(docs: DataFrame, model: dict, names: list[str]) -> DataFrame:
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in names)
    return docs.mapInArrow(_scorer(model, names), f"{schema}raw double")


def _probability(model: dict):
    """The probability of a toxic text by its raw score."""
    n0, n1 = model["n"]
    if not (n0 and n1):
        return F.lit(n1 / (n0 + n1) if n0 + n1 else 0.0)
    line = F.lit(model["slope"]) * F.col("raw") + F.lit(model["base"])
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), line))))


def scored(docs: DataFrame, model: dict, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score``, the probability that its text is toxic.

    A null or empty text has no words and gets the score of a text without toxic features.  Rows repeat as they come;
    an empty table gives an empty result.  A column named ``score`` is replaced, others (or ``carry``) pass through.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c != "score"]
    base = docs.select(*[F.col(c).alias(f"_{c}") for c in names], "text")
    raw = _raw(base, model, [f"_{c}" for c in names])
    return raw.select(*[F.col(f"_{c}").alias(c) for c in names], _probability(model).alias("score"))
