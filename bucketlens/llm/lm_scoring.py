"""Language-model scoring: a weighted backoff automaton (operator 7).

Tokens are words (A-Z in lower case) and one end token a text.

1. Counting: texts are dealt into blocks of about ``block_bytes``. A block sends
   the distinct keys of its words, pairs and triples, with their counts in its
   training texts, to parts of the key range, as packed arrays (those of triples
   in a pass of their own, which halves the disk in use). A part adds the counts up and answers each block, in the order of its keys. Every pair and
   triple that occurs at least ``least`` times (2) in the corpus is an arc,
   whatever the size of the corpus; nothing of the model is held in one place.
2. The automaton: states are contexts (no word, one word, two words). An arc
   carries the discounted probability of its word. A failure arc leads to the
   state of the shorter context and carries the back-off weight that makes the
   state's probabilities sum to one. The sums behind the weights are gathered
   by context in the same way: of the blocks that hold an n-gram, the one named
   its owner adds it to its context, and every block gets the sums of the
   contexts whose failure arcs its texts can take (a word without an arc follows).
   The empty context has the whole vocabulary: add-``alpha`` unigrams from the
   exact counts.
3. Scoring: a block builds the part of the automaton that its texts can reach.
   All texts of a block walk it from left to right at the same time: a text
   carries its state, follows failure arcs until an arc fits, and adds up the
   weights. The arc of a state and the next token is the n-gram that ends there,
   so it is looked up by that n-gram's number in the block.

Null and empty texts are the end token alone. A null doc_id is in no fold: it
is neither learned from nor held out. Repeated rows count as often as they are
there. Without a training row all counts are zero; without a row to score there is
no result. A very long text makes a block of its own. Only doc_id and text are
read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, small_batches, stored, table
from .tokens import combine, mix, words

ALPHA = 0.1
ORDER = 3
#: Pairs and triples seen this often are arcs; ``share`` can ask for more.
LEAST = 2
SHARE = 0.0
DISCOUNT = 0.75
BLOCK_BYTES = 8 << 20
#: Keys that are combined at once (bounds the work arrays).
PIECE = 1 << 18

_U = np.uint64
END = mix(np.array([0xE0D], np.uint64))[0]


def tokens_of(texts) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, each text closed by END, and the bounds of the
    texts."""
    own = words(texts)
    n = np.diff(own.first)
    first = np.concatenate(([0], np.cumsum(n + 1)))
    out = np.empty(int(first[-1]), np.uint64)
    inside = np.ones(len(out), bool)
    inside[first[1:] - 1] = False
    out[inside] = own.keys
    out[first[1:] - 1] = END
    return out, first


def gram_keys(tokens: np.ndarray, first: np.ndarray, order: int) -> np.ndarray:
    """Keys of the n-grams of one order inside the texts: the key of a context
    combined with the next token (order 1: the token itself)."""
    keys = tokens
    for k in range(1, order):
        keys = combine(keys[:-1], tokens[k:])
    return keys[gram_starts(len(tokens), first, order)]


def gram_starts(n: int, first: np.ndarray, order: int) -> np.ndarray:
    """Positions where an n-gram begins that ends inside its text."""
    ok = np.ones(max(0, n - order + 1), bool)
    for back in range(1, order):
        at = first[1:-1] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return np.flatnonzero(ok)


# -- blocks and parts --------------------------------------------------------

# Messages between blocks and parts: ``size`` keys of order k (in rising order,
# left out of answers) and two values for each. Rounds: counts, sums, sums
# without an answer.
MESSAGE = "part int, block long, round int, k int, size int, keys binary, a binary, b binary"


def _pack(values: np.ndarray) -> bytes:
    """Byte planes of an array, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, size: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, size * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, size).T).view(kind).ravel()


def _messages(block: int, round_: int, k: int, n_parts: int, keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple]:
    """One message for each part of the key range that has keys."""
    ends = np.array([(i << 64) // n_parts for i in range(1, n_parts)], np.uint64)
    cuts = [0, *np.searchsorted(keys, ends).tolist(), len(keys)]
    out = []
    for part, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if i < j:
            steps = np.diff(keys[i:j], prepend=np.zeros(1, np.uint64))
            out.append((part, block, round_, k, j - i, _pack(steps), _pack(a[i:j]), _pack(b[i:j])))
    return out


def _frame(messages: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(messages, columns=[c.split()[0] for c in MESSAGE.split(", ")])


def _answers(rows: pd.DataFrame, round_: int, k: int, kinds) -> tuple[np.ndarray, np.ndarray]:
    """Both values (unless left out) of all keys of a block, from the answers of
    the parts."""
    own = rows[(rows["round"] == round_) & (rows["k"] == k)].sort_values("part")
    out = []
    for column, kind in zip("ab", kinds):
        out.append(np.concatenate([np.zeros(0, kind), *(_unpack(d, n, kind) for d, n in zip(own[column], own["size"]) if d is not None)]))
    return out[0], out[1]


COUNTS = (np.int64, np.uint8)  # count in the corpus; whether this block is the owner
SUMS = (np.float64, np.float64)  # discounted counts of a context's arcs; lower probabilities of their words
ASK, TELL = 2, 3


def _added(rows: pd.DataFrame, kinds) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[tuple, slice, np.ndarray]]]]:
    """For each order: sums of both values by key, the first place of each key,
    and for each message its head, its places and where its keys are."""
    pa.default_memory_pool().release_unused()  # of the part before
    for _, own in rows.sort_values("block").groupby("k"):
        keys = np.concatenate([np.cumsum(_unpack(d, n, np.uint64), dtype=np.uint64) for d, n in zip(own["keys"], own["size"])])
        order = np.argsort(keys, kind="stable")
        new = np.concatenate(([True], np.diff(keys[order]) != 0))
        where = np.empty(len(keys), np.int64)
        where[order] = np.cumsum(new) - 1
        a, b = (np.concatenate([_unpack(d, n, kind) for d, n in zip(own[c], own["size"])]) for c, kind in zip("ab", kinds))
        starts = np.flatnonzero(new)
        ends = np.cumsum(own["size"].to_numpy())
        heads = zip(own["part"], own["block"], own["round"], own["k"], own["size"])
        parts = [(h, slice(e - h[4], e), where[e - h[4] : e]) for h, e in zip(heads, ends.tolist())]
        yield np.add.reduceat(a[order], starts), np.add.reduceat(b[order], starts, dtype=b.dtype), order[starts], parts


def add_counts(rows: pd.DataFrame) -> pd.DataFrame:
    """Answers with the counts of the corpus. One more row, of block -1, has the
    number of training tokens and of known words as its values."""
    out, tokens, known = [], 0, 0
    for n, _, first, parts in _added(rows, COUNTS):
        owner = np.zeros(sum(h[4] for h, _, _ in parts), np.uint8)
        owner[first] = 1
        out += [(*h, None, _pack(n[at]), _pack(owner[own])) for h, own, at in parts]
        if parts[0][0][3] == 1:
            tokens, known = int(n.sum()), int((n > 0).sum())
    summary = (int(rows["part"].iloc[0]), -1, 1, 1, 0, None, str(tokens).encode(), str(known).encode())
    return _frame([*out, summary])


def add_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Answers with the sums of the contexts that were asked for."""
    return _frame([(*h, None, _pack(a[at]), _pack(b[at])) for a, b, _, parts in _added(rows, SUMS) for h, _, at in parts if h[2] == ASK])


@dataclass
class Grams:
    """The tokens of a block with the bounds of its texts, and its distinct
    n-grams: for each order the keys (sorted) and the counts in training texts.
    Indices into the n-grams: ``word`` of each token; for each order above 1 the
    n-gram that starts at each token (where one does), and of each n-gram the
    context (order k - 1), the last word (order 1) and the n-gram without its
    first word (order k - 1)."""

    tokens: np.ndarray
    first: np.ndarray
    keys: dict[int, np.ndarray]
    learned: dict[int, np.ndarray]
    word: np.ndarray
    start: dict[int, np.ndarray]
    head: dict[int, np.ndarray]
    last: dict[int, np.ndarray]
    tail: dict[int, np.ndarray]


def grams_of(rows: pd.DataFrame, orders: Sequence[int] | None = None) -> Grams:
    """Of the texts of a block; with ``orders``, only the keys and counts of
    n-grams of these orders, without the indices."""
    links = orders is None
    pa.default_memory_pool().release_unused()  # of the block before
    parts = [tokens_of(part["text"]) for part in small_batches(rows, "text")]
    tokens = np.concatenate([t for t, _ in parts])
    n = np.concatenate([np.diff(f) for _, f in parts])
    first = np.concatenate(([0], np.cumsum(n)))
    del parts
    learn = np.repeat(rows["learn"].to_numpy().astype(bool), n)
    out = Grams(tokens, first, {}, {}, np.zeros(0, np.int32), {}, {}, {}, {})
    below = out.word  # index of the n-gram of the order below that starts at each token
    starting = tokens.copy()  # key of the n-gram that starts at each token
    for k in range(1, ORDER + 1):
        for i in range(0, len(tokens) - k + 1 if k > 1 else 0, PIECE):
            j = min(i + PIECE, len(tokens) - k + 1)
            starting[i:j] = combine(starting[i:j], tokens[i + k - 1 : j + k - 1])
        if not links and k not in orders:
            continue
        at = gram_starts(len(tokens), first, k).astype(np.int32)
        keys = starting[at]
        order = np.argsort(keys).astype(np.int32)
        keys = keys[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
        out.keys[k] = keys[new]
        del keys
        sizes = np.add.reduceat(learn[at[order]], np.flatnonzero(new), dtype=np.int32) if len(new) else np.zeros(0, np.int32)
        out.learned[k] = sizes.astype(np.int64)
        if not links:
            continue
        if k > 1:
            some = at[order[new]]
            out.head[k], out.last[k], out.tail[k] = below[some], out.word[some + k - 1], below[some + 1]
        below = np.zeros(len(tokens), np.int32)
        below[at[order]] = np.cumsum(new, dtype=np.int32) - 1
        if k == 1:
            out.word = below
        else:
            out.start[k] = below
    return out


# -- the automaton -----------------------------------------------------------


@dataclass
class Automaton:
    """State 0 is the empty context, states from ``first_pair`` on are contexts of
    two words; ``fail`` and ``weight`` (log10) are the failure arcs (a weight that
    the block's texts cannot need is NaN). ``word_state`` leads from the empty
    context to the state of a word; ``arc`` has for each order the number of each
    n-gram's arc (-1: none), ``arc_weight`` and ``arc_to`` are the arcs."""

    first_pair: int
    fail: np.ndarray
    weight: np.ndarray
    word_state: np.ndarray
    arc: dict[int, np.ndarray]
    arc_weight: np.ndarray
    arc_to: np.ndarray

    def walk(self, grams: Grams, unigram: np.ndarray) -> np.ndarray:
        """Summed log10 weights of each text, read from left to right;
        ``unigram`` holds the log10 probability of every token on its own."""
        # number of the arc, if any, that the token takes from a state of its context
        own = {k: np.full(len(grams.tokens), -1, np.int64) for k in (2, 3)}
        for k in (2, 3):
            if len(self.arc[k]):
                own[k][k - 1 :] = self.arc[k][grams.start[k][: len(grams.tokens) - k + 1]]
        n = np.diff(grams.first)
        order = np.argsort(-n, kind="stable")
        at, left = grams.first[:-1][order], n[order]
        state = np.zeros(len(n), np.int64)
        total = np.zeros(len(n))
        alive = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")
        for step, m in enumerate(alive):
            token = at[:m] + step
            s = state[:m]
            w = np.zeros(m)
            to = np.zeros(m, np.int64)
            todo = np.flatnonzero(s > 0)
            while len(todo):
                i = np.where(s[todo] >= self.first_pair, own[3][token[todo]], own[2][token[todo]])
                fits = i >= 0
                hit, i = todo[fits], i[fits]
                w[hit] += self.arc_weight[i]
                to[hit] = self.arc_to[i]
                s[hit] = -1
                todo = todo[~fits]
                w[todo] += self.weight[s[todo]]
                s[todo] = self.fail[s[todo]]
                todo = todo[s[todo] > 0]
            rest = np.flatnonzero(s == 0)
            w[rest] += unigram[token[rest]]
            to[rest] = self.word_state[grams.word[token[rest]]]
            state[:m] = to
            total[:m] += w
        out = np.empty(len(n))
        out[order] = total
        return out


def build_automaton(
    grams: Grams,
    count: dict[int, np.ndarray],
    mass: dict[int, np.ndarray],
    lower: dict[int, np.ndarray],
    least: float,
    discount: float,
) -> Automaton:
    """The arcs and states that the texts of a block can reach. ``count`` of
    every n-gram; ``mass`` and ``lower`` (sums of all arcs of the corpus) of the
    words and pairs, 0 for those that are no context of an arc, NaN for contexts
    whose failure arcs the texts cannot take."""
    state, n, weight = {}, 1, [np.zeros(1)]
    for k in (1, 2):
        heads = mass[k] != 0
        state[k] = np.where(heads, np.cumsum(heads) - 1 + n, 0)
        n += int(heads.sum())
        # the discounted mass goes back to all words by their lower probability
        rest = np.maximum(1e-9, 1.0 - mass[k][heads] / count[k][heads])
        weight.append(np.log10(rest / np.maximum(1e-9, 1.0 - lower[k][heads])))
    fail = np.zeros(n, np.int64)
    fail[state[2]] = state[1][grams.last[2]]
    fail[0] = 0
    arc, n_arcs, p, to = {}, 0, [], []
    for k in (2, 3):
        kept = count[k] >= least
        arc[k] = np.where(kept, np.cumsum(kept) - 1 + n_arcs, -1)
        n_arcs += int(kept.sum())
        p.append(np.maximum(count[k][kept] - discount, 0.0) / count[k - 1][grams.head[k][kept]])
        pair = np.flatnonzero(kept) if k == 2 else grams.tail[3][kept]
        to.append(np.where(state[2][pair] > 0, state[2][pair], state[1][grams.last[k][kept]]))
    return Automaton(
        first_pair=1 + int((mass[1] != 0).sum()),
        fail=fail,
        weight=np.concatenate(weight),
        word_state=state[1],
        arc=arc,
        arc_weight=np.log10(np.concatenate(p)),
        arc_to=np.concatenate(to),
    )


def contexts(grams: Grams, count: dict[int, np.ndarray], k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the words or pairs (order k) of a block: whether an arc leaves one in
    the block's texts; whether the texts can take its failure arc (it is frequent
    enough for arcs, and a word without one follows)."""
    arcs = count[k + 1] >= least
    follows = [np.bincount(grams.head[k + 1][own], minlength=len(count[k])) > 0 for own in (arcs, ~arcs)]
    return follows[0], follows[1] & (count[k] >= least)


# -- scoring -----------------------------------------------------------------

# Ids pass through Python as text: with nulls they would become floats.
RESULT = "doc_id string, n_tokens long, n_known long, base_score double, score double"


def score(
    docs: DataFrame,
    train: DataFrame,
    alpha: float = ALPHA,
    share: float = SHARE,
    discount: float = DISCOUNT,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, int]:
    """`(doc_id, n_tokens, n_known, base_score, score)` per row of ``docs``, and
    the number of training tokens. ``train``: a table with a column text."""
    asked = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.lit(True).alias("asked"), F.lit(False).alias("learn"))
    learned = train.select(F.lit(None).cast("string").alias("doc_id"), "text", F.lit(False).alias("asked"), F.lit(True).alias("learn"))
    return _score(asked.union(learned), alpha, share, discount, block_bytes)


def _score(texts: DataFrame, alpha: float, share: float, discount: float, block_bytes: int) -> tuple[DataFrame, int]:
    """``texts``: (doc_id as text, text, asked, learn); the flags say whether a
    row is scored and whether it is learned from."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block")
    dealt = texts.select("doc_id", "text", "asked", "learn", block).groupBy("block")

    def counts_of(orders: Sequence[int]) -> DataFrame:
        def send_counts(rows: pd.DataFrame) -> pd.DataFrame:
            own, block = grams_of(rows, orders), int(rows["block"].iloc[0])
            return _frame([m for k, keys in own.keys.items() for m in _messages(block, 1, k, n_blocks, keys, own.learned[k], np.zeros(len(keys), np.uint8))])

        return stored(dealt.applyInPandas(send_counts, MESSAGE).groupBy("part").applyInPandas(add_counts, MESSAGE), "word-counts")

    # one after the other: the messages of all orders do not lie on disk at once
    counts = counts_of((1, 2)).union(counts_of((3,)))
    totals = counts.where("block = -1").agg(*(F.coalesce(F.sum(F.col(c).cast("string").cast("long")), F.lit(0)) for c in "ab"))
    n_train, n_words = totals.first()
    least = max(float(LEAST), share * n_train)
    base: Callable = lambda n: (n + alpha) / (n_train + alpha * (n_words + 1))

    def send_sums(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        own, block = grams_of(rows), int(rows["block"].iloc[0])
        own.tokens, own.word, own.start = np.zeros(0, np.uint64), np.zeros(0, np.int32), {}  # not needed here
        (c1, _), (c2, own2), (c3, own3) = (_answers(replies, 1, k, COUNTS) for k in (1, 2, 3))
        out = []
        # every arc's pair without the first word is an arc too: it has no smaller count
        for k, n, mine, below in ((2, c2, own2, base(c1)), (3, c3, own3, None)):
            above = c1 if k == 2 else c2
            arcs = np.flatnonzero((n >= least) & (mine == 1))
            if k == 2:
                low = below[own.last[2][arcs]]
            else:
                tail = own.tail[3][arcs]
                low = np.maximum(c2[tail] - discount, 0.0) / c1[own.head[2][tail]]
            head = own.head[k][arcs]
            mass = np.bincount(head, np.maximum(n[arcs] - discount, 0.0), len(above))
            low = np.bincount(head, low, len(above))
            asked = contexts(own, {1: c1, 2: c2, 3: c3}, k - 1, least)[1]
            owns = np.bincount(head, minlength=len(above)) > 0
            for round_, those in ((ASK, asked), (TELL, owns & ~asked)):
                out += _messages(block, round_, k - 1, n_blocks, own.keys[k - 1][those], mass[those], low[those])
        return _frame(out)

    replies = counts.where("block >= 0")
    sums = stored(dealt.cogroup(replies.groupBy("block")).applyInPandas(send_sums, MESSAGE).groupBy("part").applyInPandas(add_sums, MESSAGE), "context-sums")

    def answer(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        own = grams_of(rows)
        count = {k: _answers(replies, 1, k, COUNTS)[0] for k in (1, 2, 3)}
        mass, lower = {}, {}
        for k in (1, 2):
            left, asked = contexts(own, count, k, least)
            mass[k], lower[k] = np.where(left, np.nan, 0.0), np.zeros(len(left))
            mass[k][asked], lower[k][asked] = _answers(replies, ASK, k, SUMS)
        automaton = build_automaton(own, count, mass, lower, least, discount)
        known = count[1][own.word]
        unigram = np.log10(base(known))
        out = pd.DataFrame(
            {
                "doc_id": rows["doc_id"].to_numpy(),
                "n_tokens": np.diff(own.first),
                "n_known": np.add.reduceat((known > 0).astype(np.int64), own.first[:-1]),
                "base_score": np.add.reduceat(unigram, own.first[:-1]),
                "score": automaton.walk(own, unigram),
            }
        )
        return out[rows["asked"].to_numpy().astype(bool)]

    # who owns an n-gram has been used
    replies = replies.withColumn("b", F.lit(None).cast("binary"))
    scored = dealt.cogroup(replies.union(sums).groupBy("block")).applyInPandas(answer, RESULT)
    return scored.withColumn("doc_id", F.col("doc_id").cast("bigint")), int(n_train)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = F.coalesce(crc_mod("doc_id", 10) != 0, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.lit(True).alias("asked"), learn.alias("learn"))
    scored, n_train = _score(texts, ALPHA, SHARE, DISCOUNT, BLOCK_BYTES)
    held_out = F.coalesce(crc_mod("doc_id", 10) == 0, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(n_train).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
