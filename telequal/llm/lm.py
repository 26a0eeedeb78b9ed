"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

    P(w | v) = a(b) c(v, w) / c(v) + u(b) c(w) / N + z(b) / (V + 1),      b: bucket of the context's frequency

The weights of each bucket are learned by expectation-maximisation on held-out counts: every training token is
predicted from counts that leave it out (the deleted estimate); pairs are counted in full for this.  The lowest bucket has
contexts that training does not know, or, unless every context is asked for, all outside the ``WORDS`` most frequent words;
the bigram estimate has no weight there.

Counts cover all training documents.  Words are 64-bit hashes and are counted where they stand before anything is
shuffled.  Frequent words and pairs (tables of ``WORDS`` and ``PAIRS`` entries at most) are looked up where the text
is read, so no hot key is ever shuffled; all other tokens go, packed, to the task that owns their pair (or their
word, if that is rare), are counted there exactly and scored; sums per document, packed too, meet at the document's
home.  A token after a rare context goes to the context's owner, which counts that word too; if both are rare, it is
counted by the word's owner and goes on to the context's.  The number of owners follows the number of tokens.

Tokens are A-Z-lower-cased runs of anything but white space, then one end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telequal.llm import text as tx
from telequal.session import durable

WORDS = 1 << 19
PAIRS = 1 << 19
#: Candidates for the table of pairs that a task names, as a share of its tokens.
NAMED = 1 / 16
#: Tokens per owner.
OWNED = 4_000_000
#: Tokens that a task counts before it sends its pairs on.
HELD = 2_000_000
END = np.uint64(0x1B873593CC9E2D51)
_SUMS = "uid long, n long, known long, base double, score double"


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return tx.mix(v * np.uint64(0xD6E8FEB86659FD93) + w)


def tokens(block: tx.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with an end after each text, the token before each (the end, for the first), and the rows."""
    first, last, row = block.words(tx.SPACED)
    n = len(block)
    at = np.arange(len(row)) + row
    ends = tx.offsets(row, n)[1:] + np.arange(n)
    w = np.full(len(row) + n, END, np.uint64)
    w[at] = block.hashes(first, last)
    rows = np.empty(len(w), np.int64)
    rows[at], rows[ends] = row, np.arange(n)
    before = np.concatenate(([END], w[:-1])) if len(w) else w
    return w, before, rows


def _find(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each value in sorted keys, -1 if it is not there."""
    if not len(keys):
        return np.full(len(x), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, at, -1)


def _at(counts: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Counts at places, 0 at -1."""
    return np.append(counts, 0)[place]


def _look_up(keys: np.ndarray, counts: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _at(counts, _find(keys, x))


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, np.uint64)
    counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
    unique, inverse = np.unique(keys, return_inverse=True)
    return unique, np.bincount(inverse, counts, len(unique)).astype(np.int64)


def _rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(counts)], names=["kind", "key", "n"]
    )


def _table(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` most frequent keys, sorted by key."""
    t = rows.orderBy(F.desc("n"), "key").limit(size).toArrow()
    keys = t.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], t.column("n").to_numpy()[order]


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context without a table entry, else 1 and more by powers of four."""
    return np.where(context > 0, 1 + (np.log2(np.maximum(context, 1)) / 2).astype(np.int64), 0)


class Model:
    """What every task needs: frequent words and pairs, totals, and the weights of each bucket."""

    def __init__(self, words, pairs, total: int, distinct: int) -> None:
        self.words, self.pairs, self.total, self.distinct = words, pairs, total, distinct
        self.weights = np.array([[0.0, 0.5, 0.5]] + [[0.4, 0.5, 0.1]] * 40)

    def estimates(self, pair, context, word, left_out: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
        two = np.where(context > left_out, (pair - left_out) / np.maximum(context - left_out, 1), 0.0)
        return two, (word - left_out) / max(1, self.total - left_out), 1 / (self.distinct + 1)

    def log10(self, pair, context, word) -> np.ndarray:
        w = self.weights[bucket(context)]
        two, one, none = self.estimates(pair, context, word)
        return np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] * none)

    def base(self, word: np.ndarray) -> np.ndarray:
        return np.log10((word + 1.0) / (float(self.total) + self.distinct + 1.0))

    def learn(self, cells: list[tuple[int, float, float, int]], rounds: int = 60) -> None:
        """Expectation-maximisation per bucket over (bucket, bigram and unigram estimate, count)."""
        none = 1 / (self.distinct + 1)
        for b in {c[0] for c in cells}:
            two, one, n = (np.array(x, float) for x in list(zip(*[c for c in cells if c[0] == b]))[1:])
            p = np.stack([two, one, np.full(len(n), none)])
            w = np.array([0.4, 0.5, 0.1]) if b else np.array([0.0, 0.7, 0.3])
            for _ in range(rounds):
                part = w[:, None] * p
                w = (part / part.sum(axis=0) * n).sum(axis=1) / n.sum()
                w = np.maximum(w, [1e-6 if b else 0.0, 1e-6, 1e-6])
                w /= w.sum()
            self.weights[b] = w


def _pack(arrays: list[np.ndarray]) -> bytes:
    head = np.array([len(a) for a in arrays], np.int32).tobytes()
    return head + b"".join(a.tobytes() for a in arrays)


#: Of a payload's arrays: by pair (documents, their tokens, places of both words in the table), by word (documents,
#: their tokens, word, pair, count of the context), by context (documents, their tokens, context, place of the word), by word
#: after a rare context (documents, their tokens, word, context), sums on the spot.
_KINDS = (
    *(np.int64, np.int32, np.uint64),
    *(np.int64, np.int32, np.uint64, np.uint64, np.uint32),
    *(np.int64, np.int32, np.uint64, np.int32),
    *(np.int64, np.int32, np.uint64, np.uint64),
    *(np.int64, np.int64, np.int64, np.float64, np.float64),
)


#: To learn from: pairs (places of both words) and their tokens; tokens by word (word, pair, count of the context), by context
#: (context, place of the word), and by word after a rare context (word, context).
_LEARN_KINDS = (np.uint64, np.uint32, np.uint64, np.uint64, np.uint32, np.uint64, np.int32, np.uint64, np.uint64)
#: Of the sums per document: uid, tokens, known ones, and the two scores.
_SUM_KINDS = _KINDS[-5:]
#: For a context's owner: context, counts of word and pair; words and their counts.
_ASK_KINDS = (np.uint64, np.int64, np.int64, np.uint64, np.int64)


def _unpack(data: bytes, kinds=_KINDS) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int32, len(kinds))
    out, at = [], 4 * len(kinds)
    for kind, n in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _dealt(*groups: tuple[np.ndarray, list[np.ndarray]]) -> pa.RecordBatch:
    """Rows (owner, payload) of groups of arrays, each with the owner of every entry."""
    order = [np.argsort(o, kind="stable") for o, _ in groups]
    held = [(o[i], [x[i] for x in arrays]) for i, (o, arrays) in zip(order, groups)]
    present = np.unique(np.concatenate([o for o, _ in held]))
    cuts = [(np.searchsorted(o, present), np.searchsorted(o, present, "right")) for o, _ in held]
    made = [
        _pack([x[a[at] : b[at]] for (a, b), (_, arrays) in zip(cuts, held) for x in arrays]) for at in range(len(present))
    ]
    return pa.RecordBatch.from_arrays([pa.array(present.astype(np.int32)), pa.array(made, pa.binary())], names=["owner", "payload"])


def _routes(w, before, model: Model, known: np.ndarray, every: bool):
    """Places of context and word in the table of words and of the pair in ``known``, the pairs, and which tokens must
    go to an owner, by pair, by word, by context, or by word and then by context."""
    context, word = _find(model.words[0], before), _find(model.words[0], w)
    key = _pair(before, w)
    pair = np.where(context >= 0, _find(known, key), -1)
    rare = (context < 0) & every
    by_word, by_both = (word < 0) & ~rare, (word < 0) & rare
    by_pair, by_context = (word >= 0) & (context >= 0) & (pair < 0), (word >= 0) & rare
    return context, word, key, pair, by_pair, by_word, by_context, by_both


def _both(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Two places in one number; -1 stays -1."""
    return (context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)


def _places(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (both >> np.uint64(32)).astype(np.uint32).astype(np.int32), both.astype(np.uint32).astype(np.int32)


def _counts_of(both: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Counts of context and word of pairs given by their places."""
    context, word = _places(both)
    return _at(model.words[1], context), _at(model.words[1], word)


def _packed(block, uid, train, w, before, rows, model: Model, owners: int, every: bool):
    """(owner, payload) of a block: its tokens by owner, and sums of what was scored on the spot."""
    at_context, at_word, key, pair, *sent = _routes(w, before, model, model.pairs[0], every)
    by_pair, by_word, by_context, by_both = sent
    context, word, pair = _at(model.words[1], at_context), _at(model.words[1], at_word), _at(model.pairs[1], pair)
    now = ~(by_pair | by_word | by_context | by_both)
    n = len(block)
    base, score = model.base(word[now]), model.log10(pair[now], context[now], word[now])
    local = [
        uid,
        np.bincount(rows[now], minlength=n),
        np.bincount(rows[now], word[now] > 0, minlength=n).astype(np.int64),
        np.bincount(rows[now], base, minlength=n),
        np.bincount(rows[now], score, minlength=n),
    ]
    owner = np.where(by_word | by_both, w, np.where(by_context, before, key)) % np.uint64(owners)
    at = [np.flatnonzero(x) for x in sent]
    at = [x[np.argsort(owner[x], kind="stable")] for x in at]
    home = uid.view(np.uint64) % np.uint64(owners)
    r = np.argsort(home, kind="stable")
    placed = [*(owner[x] for x in at), home[r]]
    present = np.unique(np.concatenate(placed))
    cuts = [(np.searchsorted(o, present), np.searchsorted(o, present, "right")) for o in placed]
    for o, edges in zip(present.tolist(), np.stack([x for c in cuts for x in c], axis=1).tolist()):
        i, j, c, d = (x[a:b] for x, a, b in zip(at, edges[::2], edges[1::2]))
        k = r[edges[-2] : edges[-1]]
        yield o, _pack(
            [
                *_by_row(rows[i], uid, train), _both(at_context[i], at_word[i]),
                *_by_row(rows[j], uid, train), w[j], key[j], context[j].astype(np.uint32),
                *_by_row(rows[c], uid, train), before[c], at_word[c].astype(np.int32),
                *_by_row(rows[d], uid, train), w[d], before[d],
                *[x[k] for x in local],
            ]
        )


def _by_row(row: np.ndarray, uid: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents in order and how many tokens each has; held-out ones have a negative count."""
    edge = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    n = np.diff(np.append(edge, len(row)))
    doc = row[edge]
    # An owner's tokens keep the order of the block, so each document is one run.
    return uid[doc], np.where(train[doc], n, -n).astype(np.int32)


def _of_each(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every entry the sum of the weights of its key; which entry is the first of its key."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    return np.bincount(inverse, weight).astype(np.int64)[inverse], first


def _cells(model: Model, pair, context, word, n) -> np.ndarray:
    """Tokens by bucket and by their estimates without themselves, on a grid of quarter powers of two: four columns."""
    two, one, _ = model.estimates(pair, context, word, left_out=1)
    grid = lambda p: np.where(p > 0, np.round(np.log2(np.maximum(p, 1e-30)) * 4), -999).astype(np.int64)
    code = (bucket(context) << 24) | ((grid(two) + 1024) << 12) | (grid(one) + 1024)
    cell, inverse = np.unique(code, return_inverse=True)
    return np.stack([cell >> 24, (cell >> 12 & 4095) - 1024, (cell & 4095) - 1024, np.bincount(inverse, n, len(cell)).astype(np.int64)])


def _rare_counts(word_key: np.ndarray, more: np.ndarray, weight: np.ndarray):
    """Counts of the rare words in two lists, for every entry of each; and these words, sorted, with their counts."""
    both = np.concatenate((word_key, more))
    count, first = _of_each(both, weight)
    return count[: len(word_key)], count[len(word_key) :], both[first], count[first]


def _each(uid: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and whether in training of every token; the opposite of :func:`_by_row`."""
    return np.repeat(uid, abs(n)), np.repeat(n > 0, abs(n))


def _owned(parts: list[tuple], model: Model, later: list):
    """All tokens of one owner, counted, part by part: uid, pair, context and word counts.  ``later`` gets those that go on to
    their context's owner (uid, context, word and pair counts), and the owner's words and their counts."""

    def joined(a: int, b: int) -> list[np.ndarray]:
        return [np.concatenate(x) for x in parts[a:b]]

    uid, n, both = joined(0, 3)
    uid, train = _each(uid, n)
    pair = _of_each(both, train)[0]
    context, word = _counts_of(both, model)
    yield uid, np.where(context > 0, pair, 0), context, word

    (uid, n, word_key, key, context), (uid4, n4, w4, v4) = joined(3, 8), joined(12, 16)
    (uid, train), (uid4, train4) = _each(uid, n), _each(uid4, n4)
    word, word4, words, counts = _rare_counts(word_key, w4, np.concatenate((train, train4)))
    later.append([uid4, v4, word4, _of_each(_pair(v4, w4), train4)[0]])
    later.append([words, counts])
    context = context.astype(np.int64)
    yield uid, np.where(context > 0, _of_each(key, train)[0], 0), context, word

    uid, n, v, place = joined(8, 12)
    uid, train = _each(uid, n)
    pair = _of_each(_pair(v, model.words[0][place]), train)[0]
    yield uid, pair, _look_up(words, counts, v), _at(model.words[1], place)


def _by_owner(judge):
    """Task function over (owner, payload) rows sorted by owner."""

    def run(batches):
        held: list[bytes] = []
        now = None
        for batch in batches:
            for o, data in zip(batch.column("owner").to_pylist(), batch.column("payload").to_pylist()):
                if o != now and held:
                    yield judge(held)
                    held = []
                now = o
                held.append(data)
        if held:
            yield judge(held)

    return run


def _arrow(batch: pa.RecordBatch, *columns: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]


def scored(docs: DataFrame, training: str = "true", every_context: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``, without ``text``.

    ``training`` is a condition on the rows to learn from.  A null or empty text is one end.  Equal rows (id and text)
    have equal scores; each counts in training.  Without training rows nothing is known and all estimates are uniform.
    An empty table gives an empty result.  Columns named like the added ones are replaced.  With ``every_context`` contexts
    outside the table of frequent words have a bigram estimate too.
    """
    sc = docs.sparkSession.sparkContext
    names = [c for c in docs.columns if c not in ("text", "n_tokens", "n_known", "train_tokens", "base_score", "score", "uid", "_train")]
    read = docs.select(
        *names, "text", F.xxhash64("doc_id", "text").alias("uid"), F.coalesce(F.expr(training), F.lit(False)).alias("_train")
    )
    texts = read.select("uid", "_train", "text")

    def count(batches):
        words: list = []
        pairs: list = []

        def flush():
            if words:
                yield _rows(0, *_counted(words))
                keys, n = _counted(pairs)
                most = max(1, int(n.sum() * NAMED))
                if len(n) > most:
                    top = np.argpartition(-n, most)[:most]
                    keys, n = keys[top], n[top]
                yield _rows(1, keys[n > 1], n[n > 1])
                words.clear()
                pairs.clear()

        size = 0
        for block in tx.blocks(batches):
            (train,) = _arrow(block.batch, "_train")
            w, before, rows = tokens(block)
            use = train[rows].astype(bool)
            w, before = w[use], before[use]
            words.append(np.unique(w, return_counts=True))
            pairs.append(np.unique(_pair(before, w), return_counts=True))
            size += len(w)
            if size > 4_000_000:
                yield from flush()
                size = 0
        yield from flush()

    counts = durable(
        texts.mapInArrow(count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    )
    totals = counts.where("kind = 0").agg(F.sum("n"), F.count("*")).first()
    model = Model(_table(counts.where("kind = 0"), WORDS), (np.zeros(0, np.uint64), np.zeros(0, np.int64)), totals[0] or 0, totals[1])
    named, _ = _table(counts.where("kind = 1"), PAIRS)
    owners = max(1, math.ceil((totals[0] or 0) / OWNED))
    shared, wanted = sc.broadcast(model), sc.broadcast(named)
    every = every_context and (totals[1] or 0) > len(model.words[0])  # else training knows no other contexts

    # All training tokens, to learn from: pairs of table words are counted where they stand; so is a word after a rare one,
    # unless every context counts.
    def learn(batches):
        model = shared.value
        pairs: list = []
        rare: list = []

        def flush():
            both, n = _counted(pairs)
            words = [np.concatenate(x) for x in zip(*rare)]
            sent = []
            groups = ((words[0], words[:3]), (words[3], words[3:5]), (words[5], words[5:]))
            for by, arrays in ((tx.mix(both), (both, n.astype(np.uint32))), *groups):
                owner = (by % np.uint64(owners)).astype(np.int64)
                order = np.argsort(owner, kind="stable")
                sent += [(tx.offsets(owner[order], owners), x[order]) for x in arrays]
            for o in range(owners):
                payload = [x[edge[o] : edge[o + 1]] for edge, x in sent]
                if any(map(len, payload)):
                    yield pa.RecordBatch.from_arrays([pa.array([o], pa.int32()), pa.array([_pack(payload)], pa.binary())], names=["owner", "payload"])
            pairs.clear()
            rare.clear()

        size = 0
        for block in tx.blocks(batches):
            (train,) = _arrow(block.batch, "_train")
            w, before, rows = tokens(block)
            use = train[rows].astype(bool)
            w, before = w[use], before[use]
            context, word = _find(model.words[0], before), _find(model.words[0], w)
            lone = (context < 0) & every
            near, far, c, d = (word >= 0) & ~lone, (word < 0) & ~lone, (word >= 0) & lone, (word < 0) & lone
            pairs.append(np.unique(_both(context[near], word[near]), return_counts=True))
            by_word = w[far], _pair(before[far], w[far]), _at(model.words[1], context[far]).astype(np.uint32)
            rare.append((*by_word, before[c], word[c].astype(np.int32), w[d], before[d]))
            size += len(w)
            if size > HELD:
                yield from flush()
                size = 0
        if pairs:
            yield from flush()

    def held_out(payloads):
        model, named = shared.value, wanted.value
        both, n, word_key, key, context, v3, place3, w4, v4 = (
            np.concatenate(x) for x in zip(*[_unpack(x, _LEARN_KINDS) for x in payloads])
        )
        pair, first = _of_each(both, n)
        both, pair = both[first], pair[first]
        before, word = _counts_of(both, model)
        ones, ones3 = np.ones(len(key)), np.ones(len(v3))
        context = context.astype(np.int64)
        again = np.where(context > 0, _of_each(key, ones)[0], 0)
        word2, word4, words, counts = _rare_counts(word_key, w4, np.ones(len(word_key) + len(w4)))
        pair3 = _of_each(_pair(v3, model.words[0][place3]), ones3)[0]
        found = np.hstack(
            [
                _cells(model, np.where(before > 0, pair, 0), before, word, pair),
                _cells(model, again, context, word2, ones),
                _cells(model, pair3, _look_up(words, counts, v3), _at(model.words[1], place3), ones3),
            ]
        )
        place = np.full(len(both), -1)
        ends = _places(both)
        within = ends[0] >= 0
        place[within] = _find(named, _pair(model.words[0][ends[0][within]], model.words[0][ends[1][within]]))
        kept = place >= 0
        more = np.zeros(int(kept.sum()), np.int64)
        columns = [np.concatenate(x) for x in zip((*found, np.full(found.shape[1], -1)), (more, more, more, pair[kept], place[kept]))]
        rows = [pa.array(x.astype(np.int64)) for x in columns]
        if every:
            pair4, first = _of_each(_pair(v4, w4), np.ones(len(v4)))
            ask = _dealt((v4[first] % np.uint64(owners), [v4[first], word4[first], pair4[first]]), (words % np.uint64(owners), [words, counts]))
            rows = [pa.concat_arrays([x, pa.nulls(len(ask), pa.int64())]) for x in rows]
            rows += [pa.concat_arrays([pa.nulls(len(columns[0]), x.type), x]) for x in ask.columns]
        return pa.RecordBatch.from_arrays(rows, names=["b", "two", "one", "n", "place", "owner", "payload"][: len(rows)])

    def answered(payloads):
        """Cells of the tokens whose word and context are both rare, at the context's owner."""
        context, word, pair, words, counts = (np.concatenate(x) for x in zip(*[_unpack(x, _ASK_KINDS) for x in payloads]))
        order = np.argsort(words)
        found = _cells(shared.value, pair, _look_up(words[order], counts[order], context), word, pair)
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], names=["b", "two", "one", "n"])

    width = max(1, min(owners, 10_000))
    cell = "b long, two long, one long, n long"
    learnt = durable(
        texts.mapInArrow(learn, "owner int, payload binary").repartition(width, "owner").sortWithinPartitions("owner")
        .mapInArrow(_by_owner(held_out), f"{cell}, place long{', owner int, payload binary' if every else ''}")
    )
    cells = learnt.where("place < 0").select("b", "two", "one", "n")
    if every:
        asked = learnt.where("payload IS NOT NULL").select("owner", "payload").repartition(width, "owner").sortWithinPartitions("owner")
        cells = cells.union(asked.mapInArrow(_by_owner(answered), cell))
    cells = cells.groupBy("b", "two", "one").agg(F.sum("n").alias("n")).collect()  # one row per cell of a fixed grid
    exact = learnt.where("place >= 0").select("place", "n").toArrow()  # at most PAIRS rows
    place = exact.column("place").to_numpy()
    order = np.argsort(place)
    model.pairs = named[place[order]], exact.column("n").to_numpy()[order]
    value = lambda q: 0.0 if q == -999 else 2.0 ** (q / 4)
    model.learn([(r["b"], value(r["two"]), value(r["one"]), r["n"]) for r in cells])
    final = sc.broadcast(model)

    def send(batches):
        model = final.value
        for block in tx.blocks(batches, size=2 * tx.BLOCK_BYTES):
            uid, train = _arrow(block.batch, "uid", "_train")
            made = list(_packed(block, uid, train.astype(bool), *tokens(block), model, owners, every))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o for o, _ in made], pa.int32()), pa.array([x for _, x in made], pa.binary())], names=["owner", "payload"]
            )

    def summed(uid, pair, context, word, sums):
        """Sums per document, with those of some tokens added."""
        model = final.value
        ids, inverse = np.unique(np.concatenate((uid, sums[0])), return_inverse=True)
        add = lambda x, y: np.bincount(inverse, np.concatenate((x, y)), len(ids))
        return [
            ids,
            add(np.ones(len(uid)), sums[1]).astype(np.int64),
            add(word > 0, sums[2]).astype(np.int64),
            add(model.base(word), sums[3]),
            add(model.log10(pair, context, word), sums[4]),
        ]

    def homes(sums):
        """The documents' homes, where the sums of all owners meet."""
        return sums[0].view(np.uint64) % np.uint64(owners), sums

    def finish(payloads):
        parts = list(zip(*[_unpack(x) for x in payloads]))
        sums, later = [np.concatenate(x) for x in parts[16:]], []
        for tokens_ in _owned(parts, final.value, later):
            sums = summed(*tokens_, sums)
        if not every:
            return _dealt(homes(sums))
        asked, own = (x % np.uint64(owners) for x in (later[0][1], later[1][0]))
        return _dealt((asked, later[0]), (own, later[1]), homes(sums))

    def answer(payloads):
        """Tokens whose word and context are both rare, scored at the context's owner."""
        kinds = (np.int64, *_ASK_KINDS, *_SUM_KINDS)
        uid, context, word, pair, words, counts, *sums = (np.concatenate(x) for x in zip(*[_unpack(x, kinds) for x in payloads]))
        order = np.argsort(words)
        context = _look_up(words[order], counts[order], context)
        return _dealt(homes(summed(uid, pair, context, word, sums)))

    def total(payloads):
        parts = [np.concatenate(x) for x in zip(*[_unpack(x, _SUM_KINDS) for x in payloads])]
        ids, inverse = np.unique(parts[0], return_inverse=True)
        n, known, base, score = (np.bincount(inverse, x, len(ids)) for x in parts[1:])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)],
            names=["uid", "n", "known", "base", "score"],
        )

    sums = texts.mapInArrow(send, "owner int, payload binary")
    for step in (finish, answer) if every else (finish,):
        sums = sums.repartition(width, "owner").sortWithinPartitions("owner").mapInArrow(_by_owner(step), "owner int, payload binary")
    sums = sums.repartition(width, "owner").sortWithinPartitions("owner").mapInArrow(_by_owner(total), _SUMS)

    def sizes(batches):
        for block in tx.blocks(batches):
            _, _, row = block.words(tx.SPACED)
            yield tx.with_columns(block.batch, n_tokens=pa.array(np.bincount(row, minlength=len(block)) + 1)).select(
                [*names, "uid", "n_tokens"]
            )

    schema = ", ".join(f"`{c}` {read.schema[c].dataType.simpleString()}" for c in names)
    lengths = read.mapInArrow(sizes, f"{schema + ', ' if names else ''}uid long, n_tokens long")
    share = F.col("n_tokens") / F.col("n")  # equal rows were summed together
    return lengths.join(sums, "uid").select(
        *names,
        "n_tokens",
        F.round(F.col("known") * share).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") * share).alias("base_score"),
        (F.col("score") * share).alias("score"),
    )
