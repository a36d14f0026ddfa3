"""N-gram language model by deleted interpolation, trained and applied over all documents.

P(w | h) mixes the maximum-likelihood estimates of the bigram and the unigram with a uniform share; the weights depend on how
often the context h was seen (one bucket per power of two) and are learned by expectation-maximisation on a
held-out part of the training documents, whose own counts are deleted from the estimates meanwhile. The final
estimates count all training documents.

Documents are dealt into chunks once. A chunk asks for the counts of its distinct words and bigrams (``exchange``), so what is
gathered grows with the corpus and a frequent word is one entry per chunk. The weights come from a histogram of the
held-out events (context bucket and counts by sixteenths of an octave), a table whose size is bounded by the logarithms of
the counts. Everything is one job.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one end. Null and empty texts have the end only. Without
training rows every probability is 1. Rows are scored one by one (repeated rows get equal scores, and count as often as they occur);
null ids stay null. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm import exchange
from tastegrid.llm.hashing import BASE, LOWER, WHITE, mix, span_hashes, text_bytes, word_spans

END, BEGIN = np.uint64(0x656E64), np.uint64(0x626567)
EM_ROUNDS = 100
FINE = 16  # steps per octave in the histogram
ZERO = 2047  # histogram code of a count of 0
BUCKETS = 64


def tokens(data: np.ndarray, offsets: np.ndarray):
    """(unigram hash, bigram hash, first): every text's words and its end."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, WHITE)
    n = len(offsets) - 1
    first = first + np.arange(n + 1)  # one end per text before
    word = np.empty(first[-1], np.uint64)
    is_end = np.zeros(first[-1], bool)
    is_end[first[1:] - 1] = True
    word[is_end] = END
    word[~is_end] = span_hashes(low, starts, ends)[0]
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[first[:-1]] = BEGIN
    return word, mix(mix(context) * BASE + word), first


class Counted:
    """Tokens of a chunk and the places of their keys among the chunk's sorted distinct keys."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by([("_id", "ascending"), ("_text", "ascending")])
        data, offsets = text_bytes(self.table["_text"])
        word, pair, self.first = tokens(data, offsets)
        self.words, self.word = np.unique(word, return_inverse=True)
        self.pairs, self.pair = np.unique(pair, return_inverse=True)
        self.word, self.pair = self.word.astype(np.int32), self.pair.astype(np.int32)
        self.end = int(np.searchsorted(self.words, END))
        # Counting contexts: a word is a context as often as it occurs, the beginning as often as the end occurs.
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[self.first[:-1]] = self.end

    def of(self, column: str) -> np.ndarray:
        """Whether each token's text has the flag."""
        return np.repeat(self.table[column].to_numpy(zero_copy_only=False).astype(bool), np.diff(self.first))

    def replies(self, more: pa.Table):
        """Training and fold counts of the words and of the pairs."""
        rows = exchange.as_lists(more)
        out = []
        for order, keys in ((0, self.words), (1, self.pairs)):
            mine = {c: [v for v, o in zip(rows[c], rows["kind"]) if o == order] for c in ("bucket", "n", "train", "fold")}
            counts = exchange.answers(mine, ["train", "fold"], len(keys))
            out.extend(counts[c].astype(np.int64) for c in ("train", "fold"))
        return out


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 0)


def fine(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.rint(np.log2(np.maximum(count, 1)) * FINE).astype(np.int64), ZERO)


def learn_weights(bucket, together, context, single, events, n, v) -> np.ndarray:
    """Weights (BUCKETS x 3: bigram, unigram, uniform) by EM over counted events."""
    def value(code):
        return np.where(code == ZERO, 0.0, 2.0 ** (code / FINE))

    estimates = np.stack((
        np.where(context == ZERO, 0.0, np.minimum(1.0, value(together) / np.maximum(value(context), 1))),
        value(single) / max(n, 1), np.full(len(bucket), 1 / (v + 1))))
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0.0, 0.5, 0.5
    total = np.bincount(bucket, events, BUCKETS)
    for _ in range(EM_ROUNDS):
        parts = weights[bucket].T * estimates
        parts *= events / parts.sum(axis=0)
        found = np.stack([np.bincount(bucket, p, BUCKETS) for p in parts], axis=1)
        weights = np.where(total[:, None] > 0, found / np.maximum(total, 1e-300)[:, None], weights)
    return weights


ASK = [("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()),
       ("train", pa.binary()), ("fold", pa.binary())]
REPLY = [("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int32()), ("n", pa.int64()), ("train", pa.binary()), ("fold", pa.binary())]
STAT = 2    # kind of a row that holds a bucket's sums: distinct training words in n, packed token sums in train and fold
MODEL = 3   # kind of a row that holds the weights, and the training words and tokens
EVENTS = [("bucket", pa.int32()), ("together", pa.int32()), ("context", pa.int32()), ("single", pa.int32()), ("events", pa.int64())]
SCORES = [("_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
          ("base_score", pa.float64()), ("score", pa.float64())]
_DDL = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.float64(): "double"}


def _ddl(fields) -> str:
    return ", ".join(f"{n} {_DDL[t]}" for n, t in fields)


def _filled(fields, **columns) -> pa.Table:
    return pa.table([pa.array(columns[n], t) for n, t in fields], schema=pa.schema(fields))


def score_documents(docs: DataFrame, train: Column, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) per row.

    ``train`` marks the training rows and ``held_out`` those of them that the weights are learned on; both are conditions on
    ``docs``, and null counts as false.
    """
    flags = {"_train": F.coalesce(train, F.lit(False)), "_fold": F.coalesce(train & held_out, F.lit(False))}
    table, chunks = exchange.chunked(docs, id_col, text_col, extra=flags)
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(4096, 2 * chunks))

    def asked(t: pa.Table) -> pa.Table:
        c, chunk, out = Counted(t), t["chunk"][0].as_py(), []
        train, fold = c.of("_train"), c.of("_fold")
        for kind, keys, at in ((0, c.words, c.word), (1, c.pairs, c.pair)):
            rows = exchange.requests(chunk, keys, buckets, **{
                name: np.bincount(at[flag], minlength=len(keys)).astype(np.uint64) for name, flag in (("train", train), ("fold", fold))})
            out.append(_filled(ASK, kind=[kind] * len(rows["n"]), **rows))
        return pa.concat_tables(out)

    def answered(t: pa.Table) -> pa.Table:
        rows = exchange.as_lists(t)
        kind, bucket = rows["kind"][0], rows["bucket"][0]
        _, sums, place = exchange.merged(rows, ["train", "fold"])
        sums = {c: v.astype(np.uint64) for c, v in sums.items()}
        packed = {c: [exchange.pack(v[p]) for p in place] for c, v in sums.items()}
        chunk, n, kinds = list(rows["chunk"]), list(rows["n"]), [kind] * len(place)
        if kind == 0:
            chunk.append(-1), kinds.append(STAT), n.append(int((sums["train"] > 0).sum()))
            for c in sums:
                packed[c].append(exchange.pack(sums[c].sum(keepdims=True)))
        return _filled(REPLY, kind=kinds, bucket=[bucket] * len(kinds), chunk=chunk, n=n, **packed)

    def events(t: pa.Table, more: pa.Table) -> pa.Table:
        """Histogram of the held-out events, with the held-out counts deleted."""
        c = Counted(t)
        chosen = c.of("_fold")
        w, wf, p, pf = c.replies(more)
        w, p = w - wf, p - pf
        context = w[c.context[chosen]]
        code = np.stack((context_bucket(context), fine(p[c.pair[chosen]]), fine(context), fine(w[c.word[chosen]])))
        code, n = np.unique(code, axis=1, return_counts=True)
        return _filled(EVENTS, bucket=code[0], together=code[1], context=code[2], single=code[3], events=n)

    def stats(rows: pa.Table) -> tuple[int, int, int]:
        one = exchange.as_lists(rows.filter(pc.equal(rows["kind"], STAT)))
        return (sum(one["n"]), *(sum(int(exchange.unpack(x, 1)[0]) for x in one[c]) for c in ("train", "fold")))

    def model(histogram: pa.Table, sums: pa.Table) -> pa.Table:
        v, n, held = stats(sums)
        h = {c: histogram[c].to_numpy() for c in ("bucket", "together", "context", "single", "events")}
        weights = learn_weights(*(h[c] for c in ("bucket", "together", "context", "single")), h["events"].astype(float), n - held, v)
        return _filled(REPLY, kind=[MODEL], bucket=[0], chunk=[-1], n=[v], train=[np.array([n]).tobytes()], fold=[weights.tobytes()])

    def scored(t: pa.Table, more: pa.Table) -> pa.Table:
        c = Counted(t)
        learned = more.filter(pc.equal(more["kind"], MODEL))
        v, n = learned["n"][0].as_py(), int(np.frombuffer(learned["train"][0].as_py(), np.int64)[0])
        weights = np.frombuffer(learned["fold"][0].as_py()).reshape(BUCKETS, 3)
        w, _, p, _ = c.replies(more)
        single, context = w[c.word], w[c.context]
        mixed = weights[context_bucket(context)]
        chance = (mixed[:, 0] * p[c.pair] / np.maximum(context, 1) + mixed[:, 1] * single / max(n, 1) + mixed[:, 2] / (v + 1)
                  if n else np.ones(len(single)))
        begins = c.first[:-1]
        return _filled(
            SCORES, _id=c.table["_id"].to_numpy(), n_tokens=np.diff(c.first), n_known=np.add.reduceat((single > 0).astype(np.int64), begins),
            train_tokens=np.full(len(begins), n), base_score=np.add.reduceat(np.log10((single + 1) / (n + v + 1)), begins),
            score=np.add.reduceat(np.log10(chance), begins))

    grouped = table.groupBy("chunk")
    reply = grouped.applyInArrow(asked, _ddl(ASK)).groupBy("kind", "bucket").applyInArrow(answered, _ddl(REPLY)).repartition(partitions, "chunk")
    histogram = grouped.cogroup(reply.filter("chunk >= 0").groupBy("chunk")).applyInArrow(events, _ddl(EVENTS)).groupBy(
        "bucket", "together", "context", "single").agg(F.sum("events").alias("events"))
    one = lambda df: df.withColumn("_one", F.lit(1)).groupBy("_one")  # noqa: E731  bounded tables meet in one task
    weights = one(histogram).cogroup(one(reply.filter("chunk < 0"))).applyInArrow(
        lambda h, s: model(h, s), _ddl(REPLY))
    everywhere = weights.drop("chunk").crossJoin(spark.range(chunks).select(F.col("id").cast("int").alias("chunk"))).select(reply.columns)
    out = table.groupBy("chunk").cogroup(reply.filter("chunk >= 0").unionByName(everywhere).groupBy("chunk")).applyInArrow(
        lambda t, more: scored(t, more) if t.num_rows else pa.schema(SCORES).empty_table(), _ddl(SCORES))
    return out.withColumn("_id", F.when(F.col("_id") != exchange.HIGHEST, F.col("_id"))).withColumnRenamed("_id", id_col)
