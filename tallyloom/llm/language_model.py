"""Code lengths by prediction by partial matching, beside a word model as the base.

Bytes are predicted from up to ``order`` bytes before them. The counts of all contexts form
a trie, kept as one table per order whose rows are its nodes: no node is ever cut, at any
size of the corpus. A symbol is looked up in its longest known context; where it isn't
found, an escape (as likely as the context's number of distinct successors) leads to the
next shorter one, in which the successors of the longer one are excluded. A gram's
probability depends on the gram alone, so it is derived once for each distinct gram of the
corpus, by joins of the orders' tables.

Documents are taken in chunks, runs of neighbours in the input. A chunk asks for the distinct
words and grams it holds, filed in buckets by hash; a bucket adds up what all chunks have
counted and answers each of them, and the answers meet the chunk's documents again. So
neither the model nor the vocabulary is ever in one place, the driver included: a task
holds the answers to one chunk, or one bucket, of which there are twice as many as input
splits.

Defined results: a null text is the empty text, which is one end token and one end
symbol; a null id is on the learning side; repeated rows are documents of their own;
without learning documents every symbol is equally likely and each base term is 0; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.llm.common import id_remainder, row_ids
from tallyloom.session import materialize

SYMBOL_BITS = 9
SYMBOLS = 257
#: Stands before a document's first byte and after its last.
EDGE = 256
ORDER = 5
#: Bytes of text after which a chunk is complete.
CHUNK = 1 << 25
#: Bytes of text whose grams are laid out at once, and texts among them.
PIECE, PIECE_DOCS = 1 << 20, 1 << 16
#: Grams that wait until they are added to those of their chunk.
WAITING = 1 << 20
#: The end token; no word holds a space.
END = b" "
WORDS, GRAMS, DOCS = range(3)


def low_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every symbol, and where each text's grams begin.

    A gram is the context, its latest byte highest, with the symbol lowest.
    """
    sizes = np.array([len(t) for t in texts])
    begins = np.concatenate([[0], np.cumsum(sizes + order + 1)[:-1]])
    symbols = np.full(int(sizes.sum()) + (order + 1) * len(texts), EDGE, np.int64)
    for t, b in zip(texts, begins.tolist(), strict=True):
        symbols[b + order : b + order + len(t)] = np.frombuffer(t, np.uint8)
    code = symbols[order:].copy()
    for back in range(1, order + 1):
        code |= symbols[order - back : len(symbols) - back] << (SYMBOL_BITS * (order - back + 1))
    inside = np.ones(len(code), bool)
    for back in range(order):  # the edges before the next text
        inside[begins[1:] - 1 - back] = False
    return code[inside], np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])


def _shorter(code: Column) -> Column:
    """The gram without its oldest byte, which stands right above the symbol."""
    symbol = code.bitwiseAND(F.lit((1 << SYMBOL_BITS) - 1))
    return F.shiftleft(F.shiftright(code, 2 * SYMBOL_BITS), SYMBOL_BITS).bitwiseOR(symbol)


def _context(code: Column) -> Column:
    return F.shiftright(code, SYMBOL_BITS)


def log_probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``grams`` (``code``, ``n`` learned occurrences, others) with ``logp``, the natural logarithm of each one's probability.

    All grams that occur are rows, also those with ``n`` 0; they are given the probability
    that the learned ones imply.
    """
    level = materialize(grams.where("n > 0").select("code", "n"), "trie")
    levels = {order: level}
    for k in range(order - 1, -1, -1):
        level = materialize(level.groupBy(_shorter(F.col("code")).alias("code")).agg(F.sum("n").alias("n")), "trie")
        levels[k] = level
    sums = (F.sum("n").alias("total"), F.count("*").alias("distinct"))
    contexts = {k: v.groupBy(_context(F.col("code")).alias("context")).agg(*sums) for k, v in levels.items()}

    def excluded(k: int) -> DataFrame:
        """Per context of order ``k``: what weighs in the next shorter one once its own successors are out."""
        nodes = levels[k].select(_context(F.col("code")).alias("context"), _shorter(F.col("code")).alias("code"))
        again = nodes.join(levels[k - 1], "code").groupBy("context").agg(F.sum("n").alias("again"), F.count("*").alias("own"))
        below = contexts[k - 1].withColumnRenamed("context", "below")
        met = again.withColumn("below", F.shiftright("context", SYMBOL_BITS)).join(below, "below")
        left = F.col("distinct") - F.col("own")
        return met.select("context", (F.col("total") - F.col("again") + left).alias("weight"), left.alias("escape"))

    others = [c for c in grams.columns if c not in ("code", "n")]
    seen = grams.where("n > 0").withColumn("context", _context(F.col("code"))).join(contexts[order], "context")
    out = seen.select(*others, "code", (F.log("n") - F.log(F.col("total") + F.col("distinct"))).alias("logp"))
    none = F.lit(None).cast("long")
    rest = grams.where("n = 0").select(
        *others, "code", F.col("code").alias("at"), F.lit(True).alias("fresh"), F.lit(0.0).alias("gone"), none.alias("weight"), none.alias("escape")
    )
    for k in range(order, -1, -1):
        node = levels[k].select(F.col("code").alias("at"), F.col("n").alias("found"))
        met = rest.withColumn("context", _context(F.col("at"))).join(node, "at", "left").join(contexts[k], "context", "left")
        weigh = {
            "weight": F.when(F.col("fresh"), F.col("total") + F.col("distinct")).otherwise(F.col("weight")),
            "escape": F.when(F.col("fresh"), F.col("distinct")).otherwise(F.col("escape")),
        }
        met = materialize(met.withColumns(weigh), "open-grams")
        hit = met.where(F.col("found").isNotNull())
        out = out.unionByName(hit.select(*others, "code", (F.col("gone") + F.log("found") - F.log("weight")).alias("logp")))
        known = F.col("total").isNotNull()
        # With nothing left here, the escape is certain.
        price = F.when(known & (F.col("escape") > 0), F.log("escape") - F.log("weight")).otherwise(0.0)
        missed = met.where(F.col("found").isNull()).withColumns({"gone": F.col("gone") + price, "fresh": F.col("fresh") & ~known})
        if k:
            missed = missed.select(*others, "code", "at", "context", "fresh", "gone").join(excluded(k), "context", "left")
            rest = missed.withColumn("at", _shorter(F.col("at"))).drop("context")
        else:
            # Symbols never seen share what is left.
            unseen = F.greatest(SYMBOLS - F.coalesce("distinct", F.lit(0)), F.lit(1))
            out = out.unionByName(missed.select(*others, "code", (F.col("gone") - F.log(unseen)).alias("logp")))
    return out


def chunked(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, list[bytes], bool]]:
    """Pieces of a partition's documents: chunk, rows, their lowered texts, whether the chunk ends with them.

    ``__row`` and ``text`` are among the columns. A chunk is named by its first row, and the
    texts alone decide where it ends, so every pass cuts a partition alike.
    """
    chunk, held, begin = None, 0, 0
    last: tuple | None = None
    for batch in rows:
        ids = batch.column("__row").to_pylist()
        texts = [low_bytes(t) for t in batch.column("text").to_pylist()]
        begin = 0
        while begin < len(texts):
            if last is not None:
                yield (*last, held >= CHUNK)
            if chunk is None or held >= CHUNK:
                chunk, held = ids[begin], 0
            end, size = begin, 0
            while end < len(texts) and end - begin < PIECE_DOCS and size < PIECE and held < CHUNK:
                size += len(texts[end]) + 1
                held += len(texts[end]) + 1
                end += 1
            last = chunk, batch.slice(begin, end - begin), texts[begin:end]
            begin = end
    if last is not None:
        yield (*last, True)


ASKED = "chunk long, kind int, bucket int, keys binary, counts binary"


def _packed(chunk: int, kind: int, buckets: np.ndarray, n: np.ndarray, pack, limit: int) -> Iterator[dict]:
    """A row for each bucket in use; ``pack`` gives the keys at some places as bytes."""
    order = np.argsort(buckets, kind="stable")
    edges = np.searchsorted(buckets[order], np.arange(limit + 1))
    for b in np.flatnonzero(np.diff(edges)):
        at = order[edges[b] : edges[b + 1]]
        yield {"chunk": chunk, "kind": kind, "bucket": int(b), "keys": pack(at), "counts": n[at].astype("<u4").tobytes()}


def code_buckets(codes: np.ndarray, limit: int) -> np.ndarray:
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(limit)).astype(np.int64)


def _add(codes: Sequence[np.ndarray], counts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(np.concatenate(codes), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)


def asked(marked: DataFrame, order: int, buckets: int) -> DataFrame:
    """What each chunk asks for: its distinct words and grams by bucket, with their learned occurrences."""

    def requests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
        learned: Counter[bytes] = Counter()
        others: set[bytes] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for chunk, batch, texts, ends in chunked(rows):
            learns = [not h for h in batch.column("held_out").to_pylist()]
            for text, learn in zip(texts, learns, strict=True):
                words = text.split()
                words.append(END)
                (learned if learn else others).update(words)
            laid, begins = grams(texts, order)
            sizes = np.diff(np.append(begins, len(laid)))
            held.append(_counted(laid, np.repeat(learns, sizes)))
            waiting += len(held[-1][0])
            if ends or waiting > WAITING:
                held, waiting = [_add(*zip(*held, strict=True))], 0
            if ends:
                codes, counts = held.pop()
                for w in others:
                    learned.setdefault(w, 0)
                words = list(learned)
                n = np.fromiter(learned.values(), np.int64, len(words))
                at = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
                out = [*_packed(chunk, WORDS, at, n, lambda k, w=words: b"\n".join([w[i] for i in k]), buckets)]
                out += _packed(chunk, GRAMS, code_buckets(codes, buckets), counts, lambda k, c=codes: c[k].astype("<i8").tobytes(), buckets)
                yield pa.RecordBatch.from_pylist(out, schema)
                learned, others = Counter(), set()

    return marked.mapInArrow(requests, ASKED)


def _counted(codes: np.ndarray, learns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(place, learns, len(distinct)).astype(np.int64)


#: Answers to chunks, and with a null chunk a bucket's learned words and how many differ.
ANSWERS = "chunk long, kind int, bucket int, keys binary, counts binary, learned long, types long"


def word_answers(requests: DataFrame) -> DataFrame:
    """To each chunk the learned occurrences of its words in all chunks."""

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        lists = [k.split(b"\n") for k in group["keys"]]
        total: Counter[bytes] = Counter()
        for words, counts in zip(lists, group["counts"], strict=True):
            for w, n in zip(words, np.frombuffer(counts, "<u4").tolist(), strict=True):
                total[w] += n
        counts = [np.fromiter(map(total.__getitem__, words), "<i8", len(words)).tobytes() for words in lists]
        out = group[["chunk", "kind", "bucket", "keys"]].assign(counts=counts, learned=None, types=None)
        summed = {"chunk": None, "kind": WORDS, "bucket": group["bucket"].iloc[0], "keys": None, "counts": None}
        more = pd.DataFrame([summed | {"learned": sum(total.values()), "types": sum(n > 0 for n in total.values())}])
        return pd.concat([out.astype(object), more.astype(object)], ignore_index=True)

    return requests.where(F.col("kind") == WORDS).groupBy("bucket").applyInPandas(answer, ANSWERS)


def gram_counts(requests: DataFrame) -> DataFrame:
    """``bucket``, ``code`` and ``n`` of all grams of all chunks."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        codes, n = _add([np.frombuffer(k, "<i8") for k in group["keys"]], [np.frombuffer(c, "<u4") for c in group["counts"]])
        return pd.DataFrame({"bucket": group["bucket"].iloc[0], "code": codes, "n": n})

    return requests.where(F.col("kind") == GRAMS).groupBy("bucket").applyInPandas(add, "bucket int, code long, n long")


def gram_answers(requests: DataFrame, probabilities: DataFrame) -> DataFrame:
    """To each chunk the logarithms of its grams' probabilities."""

    def answer(group: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(found["code"].to_numpy())
        codes, logp = found["code"].to_numpy()[order], found["logp"].to_numpy()[order].astype("<f8")
        values = [logp[np.searchsorted(codes, np.frombuffer(k, "<i8"))].tobytes() for k in group["keys"]]
        return group[["chunk", "kind", "bucket", "keys"]].assign(counts=values)

    left = requests.where(F.col("kind") == GRAMS).groupBy("bucket")
    return left.cogroup(probabilities.groupBy("bucket")).applyInPandas(answer, ASKED)


def _folded(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def folded(marked: DataFrame) -> DataFrame:
    """The chunks' documents, as compressed pieces."""

    def pieces(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
        for i, (chunk, batch, _, _) in enumerate(chunked(rows)):
            row = {"chunk": chunk, "kind": DOCS, "bucket": i, "keys": _folded(batch), "counts": None}
            yield pa.RecordBatch.from_pylist([row], schema)

    return marked.mapInArrow(pieces, ASKED)


def _scored(rows: Iterator[pa.RecordBatch], order: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Chunk by chunk, first the answers and then the documents, in order of chunk, kind and bucket."""
    current, count = None, {}
    codes: list[np.ndarray] = []
    logp: list[np.ndarray] = []
    known = values = None
    for batch in rows:
        for chunk, kind, keys, counts in zip(*[batch.column(c).to_pylist() for c in ("chunk", "kind", "keys", "counts")], strict=True):
            if chunk != current:
                current, count, codes, logp, known = chunk, {}, [], [], None
            if kind == WORDS:
                count.update(zip(keys.split(b"\n"), np.frombuffer(counts, "<i8").tolist(), strict=True))
            elif kind == GRAMS:
                codes.append(np.frombuffer(keys, "<i8"))
                logp.append(np.frombuffer(counts, "<f8"))
            else:
                if known is None:
                    known, values = np.concatenate(codes), np.concatenate(logp)
                    by = np.argsort(known)
                    known, values = known[by], values[by]
                docs = pa.ipc.open_stream(keys).read_all().combine_chunks().to_batches()[0]
                yield _documents(docs, count, known, values, order, schema)


def _documents(docs: pa.RecordBatch, count: dict[bytes, int], known: np.ndarray, logp: np.ndarray, order: int, schema: pa.Schema) -> pa.RecordBatch:
    texts = [low_bytes(t) for t in docs.column("text").to_pylist()]
    sizes, seen = [], []
    for t in texts:
        words = t.split()
        words.append(END)
        sizes.append(len(words))
        seen.append(np.fromiter(map(count.__getitem__, words), np.int64, len(words)))
    n = np.concatenate(seen)
    first = np.cumsum(sizes) - sizes
    codes, begins = grams(texts, order)
    distinct, place = np.unique(codes, return_inverse=True)
    score = np.add.reduceat(logp[np.searchsorted(known, distinct)][place], begins) / np.log(10)
    columns = {
        "doc_id": docs.column("doc_id"),
        "held_out": docs.column("held_out"),
        "n_tokens": pa.array(sizes, pa.int64()),
        "n_known": pa.array(np.add.reduceat((n > 0).astype(np.int64), first)),
        "logs": pa.array(np.add.reduceat(np.log10(n + 0.5), first)),
        "score": pa.array(score),
    }
    return pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)


def score(
    docs: DataFrame,
    order: int = ORDER,
    folds: int = 5,
    held_out: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document: its tokens, the base score and the model's log10 probability."""
    side = F.coalesce(id_remainder(F.col(doc_id), folds) == held_out, F.lit(False))
    marked = row_ids(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), side.alias("held_out")))
    # Twice as many as splits: what a bucket gets from all of them is then less than a split asks for.
    buckets = 2 * max(marked.rdd.getNumPartitions(), 8)
    requests = materialize(asked(marked, order, buckets), "asked")
    words = materialize(word_answers(requests), "word-answers")
    sums = words.agg(F.coalesce(F.sum("learned"), F.lit(0)).alias("n"), F.coalesce(F.sum("types"), F.lit(0)).alias("v")).first()
    tokens, types = sums["n"], sums["v"]
    probabilities = log_probabilities(materialize(gram_counts(requests), "grams"), order)
    answers = words.where("chunk is not null").select("chunk", "kind", "bucket", "keys", "counts")
    met = answers.unionByName(gram_answers(requests, probabilities)).unionByName(folded(marked))
    met = met.repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket")
    out = StructType.fromDDL("held_out boolean, n_tokens long, n_known long, logs double, score double")
    out = StructType([marked.schema["doc_id"], *out])
    schema = marked.select("doc_id").limit(0).toArrow().schema
    for f in out.fields[1:]:
        schema = schema.append(pa.field(f.name, {"boolean": pa.bool_(), "bigint": pa.int64(), "double": pa.float64()}[f.dataType.simpleString()]))
    scores = met.mapInArrow(lambda rows: _scored(rows, order, schema), out)
    per_token = float(np.log10(tokens + 0.5 * (types + 1)))
    return scores.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        "score",
    )
