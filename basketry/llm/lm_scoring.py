"""Language-model scores by deleted interpolation.

The probability of a token mixes three estimates: its share after the token before it, its share
in all tokens, and a uniform one over the vocabulary.  The mixture depends on how often the
token before was seen: frequencies fall into buckets by powers of two.  The weights are learned
by expectation-maximisation on tokens that were held out of the counts; afterwards those tokens
join the counts.

A document's tokens ask for their counts in packed form (see ``packed``), the answers are kept as
one table, and both the held-out statistics and the scores are read from it.  The driver sees
only the statistics: the number of held-out tokens for each frequency bucket and each pair of
estimates, in quarter powers of two, which bounds them.

Defined results: a null text counts as empty; an empty text is one end token; a null id counts as
the id ''; repeated rows count and score each; without training rows all counts are 0 and every
token has probability 1.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import shared
from basketry.llm import packed, words

shared.ship(__name__)

FOLDS = 5
HELD_OUT = 1
#: Of the training documents, one in so many is held out of the counts to learn the weights.
DELETED_SHARE = 8
ITERATIONS = 60
_END, _BEGIN, _SINGLE = (words.mix(np.array([n], np.uint64))[0] for n in (1, 2, 3))
_STEP = np.array([0xD1342543DE82EF95], np.uint64)
_STEPS_PER_DOUBLING = 4
_NEVER = 255
#: Pairs, which are most of the keys, travel with 56 bits of their hash; single tokens with all.
_PAIR_BITS = np.uint64(0xFFFFFFFFFFFFFF00)
_LOW = 0xFFFFFFFF

_ASK = "part int, bucket int, size int, keys binary, counts binary, deleted binary, known bigint"
_ASK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("bucket", pa.int32()),
        ("size", pa.int32()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
        ("deleted", pa.binary()),
        ("known", pa.int64()),
    ]
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class _Part:
    """Tokens of one part's documents: words and one end each."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.number = table["part"][0].as_py()
        self.id_column = table["doc_id"].combine_chunks()
        fold = table["fold"].to_numpy()
        self.held_out = fold % FOLDS == HELD_OUT
        self.deleted = ~self.held_out & (fold // FOLDS % DELETED_SHARE == 0)
        got = words.Words(words.binary(table["text"]), lower=True)
        self.sizes = got.counts + 1
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        tokens = np.full(self.first[-1], _END)
        tokens[np.arange(len(got)) + got.text_of] = got.hashes()
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.first[:-1]] = _BEGIN
        self.doc_of = np.repeat(np.arange(len(fold)), self.sizes)
        #: Keys of single tokens and of pairs.
        self.keys = (words.mix(tokens ^ _SINGLE), words.mix(before * _STEP + tokens) & _PAIR_BITS)


def _ask(part: _Part, bits: int) -> pa.Table:
    """Distinct keys of the part with their training counts, and those of deleted documents."""
    trains = (~part.held_out)[part.doc_of]
    deleted = part.deleted[part.doc_of]
    rows = []
    for size, keys in enumerate(part.keys, 1):
        order = np.argsort(keys, kind="stable")
        starts = packed.groups(keys[order])
        counts = np.add.reduceat(trains[order], starts, dtype=np.uint32)
        gone = np.add.reduceat(deleted[order], starts, dtype=np.uint32)
        keys = keys[order][starts]
        for bucket, start, end in packed.cut(keys, bits):
            rows.append(
                (
                    part.number,
                    bucket,
                    size,
                    packed.pack(keys[start:end]),
                    packed.planes(counts[start:end]),
                    packed.planes(gone[start:end]),
                    0,
                )
            )
    return _table(rows, _ASK_SCHEMA)


def _answer(table: pa.Table) -> pa.Table:
    """Total counts for each part; the first part also gets the number of known tokens.

    Where a count needs more than 32 bits, the upper halves of both columns stand in ``keys``.
    """
    keys = [packed.unpack(x) for x in table["keys"].to_pylist()]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    starts = packed.groups(every[order])
    sizes = np.diff(np.append(starts, len(every)))
    totals, known = [], 0
    for name in ("counts", "deleted"):
        own = np.concatenate([packed.from_planes(x, np.uint32) for x in table[name].to_pylist()])
        summed = np.add.reduceat(own[order], starts, dtype=np.int64)
        if name == "counts" and table["size"][0].as_py() == 1:
            known = int((summed > 0).sum())
        total = np.empty(len(every), np.int64)
        total[order] = np.repeat(summed, sizes)
        totals.append(total)
    rows, at = [], 0
    for i, own in enumerate(keys):
        until = at + len(own)
        low = [(t[at:until] & _LOW).astype(np.uint32) for t in totals]
        high = np.concatenate([(t[at:until] >> 32).astype(np.uint32) for t in totals])
        rows.append(
            (
                table["part"][i].as_py(),
                table["bucket"][i].as_py(),
                table["size"][i].as_py(),
                packed.planes(high) if high.any() else b"",
                packed.planes(low[0]),
                packed.planes(low[1]),
                0 if i else known,
            )
        )
        at = until
    return _table(rows, _ASK_SCHEMA)


_COUNTED = (
    "held_out boolean, n_tokens bigint, n_known bigint, log_counts double, single binary, pair binary, "
    "known bigint, cell int, cell_count bigint"
)


def _narrow(counts: np.ndarray) -> bytes:
    """A document's counts in four bytes each, or eight where one needs them."""
    return packed.planes(counts.astype(np.uint32) if counts.max() <= _LOW else counts)


def _widened(data: bytes, n_tokens: int) -> np.ndarray:
    return packed.from_planes(data, np.dtype(f"u{len(data) // n_tokens}"))


def _context(single: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Counts of the tokens before; the start of a text is as frequent as ends are."""
    before = np.empty_like(single)
    before[1:] = single[:-1]
    before[first[:-1]] = single[first[1:] - 1]
    return before


def _halvings(ratio: np.ndarray) -> np.ndarray:
    return np.round(np.log2(ratio) * _STEPS_PER_DOUBLING).astype(np.int64)


def _cells(single: np.ndarray, pair: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Frequency bucket and rounded estimates of tokens, as one number."""
    bucket = np.log2(context + 1.0).astype(np.int64)
    after = np.where(pair > 0, _halvings(np.maximum(context, 1) / np.maximum(pair, 1)), _NEVER)
    alone = np.where(single > 0, _halvings(np.maximum(single, 1)), _NEVER)
    return (bucket << 16) | (np.minimum(after, _NEVER) << 8) | np.minimum(alone, _NEVER)


def _counted(part: _Part, answers: pa.Table, kind: pa.DataType) -> pa.Table:
    """Counts of every document's tokens, and the statistics of the deleted ones."""
    answers = answers.sort_by([("size", "ascending"), ("bucket", "ascending")])
    found = {}
    for size, keys in enumerate(part.keys, 1):
        own = answers.filter(pa.compute.equal(answers["size"], size))
        distinct, inverse = np.unique(keys, return_inverse=True)
        upper = own["keys"].to_pylist()
        for half, name in enumerate(("counts", "deleted")):
            told = [packed.from_planes(x, np.uint32) for x in own[name].to_pylist()]
            for i, high in enumerate(upper):
                if high:
                    halves = np.split(packed.from_planes(high, np.uint32), 2)
                    told[i] = told[i] + (halves[half].astype(np.uint64) << np.uint64(32))
            total = np.concatenate(told) if told else np.zeros(0, np.uint32)
            if len(total) != len(distinct):
                raise ValueError("a part was answered for other tokens than it asked for")
            found[size, name] = total[inverse]
    single, pair = found[1, "counts"], found[2, "counts"]
    logs = np.log10(single + 0.5)
    first = part.first[:-1]
    n = len(part.sizes)
    cells, cell_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    gone = part.deleted[part.doc_of]
    if gone.any():
        rest_single = single - found[1, "deleted"]
        rest = _cells(
            rest_single[gone],
            (pair - found[2, "deleted"])[gone],
            _context(rest_single, part.first)[gone],
        )
        cells, cell_counts = np.unique(rest, return_counts=True)
    docs = pa.table(
        {
            "doc_id": part.id_column,
            "held_out": pa.array(part.held_out),
            "n_tokens": pa.array(part.sizes, pa.int64()),
            "n_known": pa.array(np.add.reduceat(single > 0, first, dtype=np.int64)),
            "log_counts": pa.array(np.add.reduceat(logs, first)),
            "single": pa.array([_narrow(x) for x in np.split(single, part.first[1:-1])], pa.binary()),
            "pair": pa.array([_narrow(x) for x in np.split(pair, part.first[1:-1])], pa.binary()),
            "known": pa.nulls(n, pa.int64()),
            "cell": pa.nulls(n, pa.int32()),
            "cell_count": pa.nulls(n, pa.int64()),
        }
    )
    told = int(sum(answers["known"].to_pylist()))
    m = len(cells) + 1
    statistics = pa.table(
        {
            "doc_id": pa.nulls(m, kind),
            "held_out": pa.nulls(m, pa.bool_()),
            **{c: pa.nulls(m, pa.int64()) for c in ("n_tokens", "n_known")},
            "log_counts": pa.nulls(m, pa.float64()),
            **{c: pa.nulls(m, pa.binary()) for c in ("single", "pair")},
            "known": pa.array([told] + [0] * len(cells), pa.int64()),
            "cell": pa.array([None, *cells.tolist()], pa.int32()),
            "cell_count": pa.array([None, *cell_counts.tolist()], pa.int64()),
        }
    )
    return pa.concat_tables([docs, statistics])


def learn_weights(cells: list[tuple[int, int]], tokens: int, vocabulary: int) -> np.ndarray:
    """Weights of (uniform, single, pair) for every frequency bucket, by EM on held-out cells.

    A bucket without held-out tokens gets the weights of all buckets together.
    """
    even = 1.0 / (vocabulary + 1)
    number = np.array([c for c, _ in cells], np.int64)
    count = np.array([n for _, n in cells], float)
    bucket, after, alone = number >> 16, number >> 8 & 255, number & 255
    pair = np.where(after == _NEVER, 0.0, 2.0 ** (-after / _STEPS_PER_DOUBLING))
    single = np.where(alone == _NEVER, 0.0, 2.0 ** (alone / _STEPS_PER_DOUBLING) / max(tokens, 1))
    estimates = np.stack([np.full(len(pair), even), np.minimum(single, 1), pair], 1)

    def fit(rows):
        weights = np.full(3, 1 / 3)
        for _ in range(ITERATIONS if rows.any() else 0):
            shares = estimates[rows] * weights
            shares *= (count[rows] / shares.sum(1))[:, None]
            # One token is always left to the uniform estimate, so that no weight becomes zero.
            total = shares.sum(0) + np.array([1.0, 0.0, 0.0])
            weights = total / total.sum()
        return weights

    pooled = fit(np.ones(len(number), bool))
    out = np.tile(pooled, (64, 1))
    for b in np.unique(bucket):
        out[b] = fit(bucket == b)
    out[0, 2] = 0.0  # nothing was seen after an unseen token
    return out / out.sum(1, keepdims=True)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    docs = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("fold"),
    )
    dealt, bits = packed.parts(docs)
    kind = words.kind_of(docs, "doc_id")

    def ask(table):
        return _ask(_Part(table), bits)

    def counted(table, answers):
        return _counted(_Part(table), answers, table.schema.field("doc_id").type)

    asked = dealt.groupBy("part").applyInArrow(ask, _ASK)
    answers = asked.groupBy("bucket", "size").applyInArrow(_answer, _ASK)
    found = shared.stage(
        dealt.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(counted, f"doc_id {kind}, {_COUNTED}"),
        "token-counts",
        codec="zstd",
    )
    trains = F.when(~F.col("held_out"), F.col("n_tokens"))
    gone = F.col("cell").isNotNull()
    tokens, vocabulary, deleted = found.agg(
        F.coalesce(F.sum(trains), F.lit(0)),
        F.coalesce(F.sum("known"), F.lit(0)),
        F.coalesce(F.sum(F.when(gone, F.col("cell_count"))), F.lit(0)),
    ).first()
    cells = found.where(gone).groupBy("cell").agg(F.sum("cell_count").alias("n")).orderBy("cell")
    weights = learn_weights([tuple(r) for r in cells.collect()], tokens - deleted, vocabulary)

    def finish(batches):
        even = 1.0 / (vocabulary + 1)
        for batch in batches:
            sums = []
            columns = (batch.column(i).to_pylist() for i in (2, 4, 5))
            for n, single, pair in zip(*columns, strict=True):
                single, pair = _widened(single, n), _widened(pair, n)
                context = _context(single, np.array([0, len(single)]))
                own = weights[np.log2(context + 1.0).astype(np.int64)]
                mixed = own[:, 0] * even + own[:, 1] * (single / max(tokens, 1))
                mixed += own[:, 2] * (pair / np.maximum(context, 1))
                sums.append(float(np.log10(mixed).sum()))
            base = np.log10(tokens + 0.5 * (vocabulary + 1))
            size, logs = batch.column(2).to_numpy(), batch.column(6).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(4)),
                    pa.array(np.full(batch.num_rows, tokens), pa.int64()),
                    pa.array(logs - size * base, pa.float64()),
                    pa.array(sums, pa.float64()),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    rows = found.where("n_tokens IS NOT NULL").select(
        "doc_id", "held_out", "n_tokens", "n_known", "single", "pair", "log_counts"
    )
    return rows.mapInArrow(
        finish,
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
