"""Token counts of whole texts under a sentencepiece model, without token ids.

A piece never crosses the start of a run of spaces, so a text's count is the sum over
its pre-tokens (a run of spaces and what follows up to the next space). The work:

1. Pre-tokens are counted over the corpus (counted within each task, then a
   partial aggregation), and every distinct pre-token is encoded once.
2. The frequent pre-tokens, at most ``head_rows`` of them by a threshold on their
   corpus frequency, go to every task as a table of that proven size; each document's
   frequencies of them are summed on the spot.
3. All other pre-tokens of a document (rare ones, by construction never a hot key) are
   joined to the piece counts with a shuffle and summed per document.

The two ways together are exact at any vocabulary size; the shuffle carries only the
rare tail.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from unitmesh.llm.common import col, ready, written

LIMIT = 4096
HEAD_ROWS = 400_000
HEAD_CHARS = 64
_HELD_TOKENS = 200_000
_RUNS = re.compile(r" +[^ ]*")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without its first space (the model puts a space
    before the text). The model's space sign U+2581 counts as a space."""
    if not text:
        return []
    text = text.replace("▁", " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [run[1:] for run in _RUNS.findall(" " + text)]


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_counts(model, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token. The empty one is a single space: the model's sign for
    a space before nothing, which it drops in an empty text but counts in a longer one."""
    return [len(ids) if t else 1 for t, ids in zip(tokens, model.encode(tokens, num_threads=1), strict=True)]


def check_model(path: str) -> None:
    """Raise unless the model is one whose pieces stay within pre-tokens."""
    model = _model(path)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if "▁" in piece.lstrip("▁"):
            raise ValueError(f"piece {piece!r} crosses a space; counts do not add up over pre-tokens")
    for probe in ("a  ½ﬁ b", " x", "x "):  # no normalisation, space before the text
        if model.decode(model.encode(probe)) != probe:
            raise ValueError("the model normalises its input")


def _corpus_batches(batches):
    """Pre-token counts of a task, passed on whenever many have come together."""
    seen: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["_token", "_times"])
        seen.clear()
        return out

    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(pre_tokens(text or ""))
        if len(seen) > _HELD_TOKENS:
            yield flush()
    if seen:
        yield flush()


def _encode_batches(path: str):
    def run(batches):
        model = _model(path)
        for batch in batches:
            counts = piece_counts(model, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["_token", "_times", "_pieces"])
    return run


def _document_batches(head):
    def run(batches):
        known = head.value
        for batch in batches:
            sums, ends, tokens, counts = [], [0], [], []
            for text in batch.column(1).to_pylist():
                total = 0
                for token, times in Counter(pre_tokens(text or "")).items():
                    pieces = known.get(token)
                    if pieces is None:
                        tokens.append(token)
                        counts.append(times)
                    else:
                        total += pieces * times
                sums.append(total)
                ends.append(len(tokens))
            pairs = pa.StructArray.from_arrays([pa.array(tokens, pa.string()), pa.array(counts, pa.int64())], names=["_token", "_times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                names=["_row", "_sum", "_tail"])
    return run


def _head(vocabulary: DataFrame, rows: int, chars: int) -> tuple[dict, int]:
    """The frequent short pre-tokens with their piece counts, at most ``rows``, and the
    power of two their frequency reaches: found from a histogram over that power."""
    level = F.floor(F.log2("_times")).cast("int")
    short = F.length("_token") <= chars
    least, total = 64, 0
    for r in vocabulary.where(short).groupBy(level.alias("_level")).count().orderBy(F.desc("_level")).collect():
        if total + r["count"] > rows:
            break
        least, total = r["_level"], total + r["count"]
    found = vocabulary.where(short & (level >= least)).select("_token", "_pieces").toArrow()
    return dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True)), least


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, head_rows: int = HEAD_ROWS) -> DataFrame:
    """(id, ``n_bytes``, ``n_tokens``, ``over_limit``) for every row of ``docs``: the
    UTF-8 bytes and the model's tokens of the whole text, without begin, end or added
    special tokens; strings that look like special tokens are ordinary text.

    A null or empty text has 0 bytes and 0 tokens. Every row keeps its own result, also
    rows that repeat or have a null id. An empty table gives an empty table. Extra
    columns are not read. ``model_path`` must exist on the executors.
    """
    spark = docs.sparkSession
    ready(spark)
    check_model(model_path)
    ready(spark)
    text = col(text_col)
    vocabulary = written(
        docs.select(text.alias("_text")).mapInArrow(_corpus_batches, "_token string, _times long")
        .groupBy("_token").agg(F.sum("_times").alias("_times"))
        .mapInArrow(_encode_batches(model_path), "_token string, _times long, _pieces long"), "token-vocabulary")
    known, least = _head(vocabulary, head_rows, HEAD_CHARS)
    head = spark.sparkContext.broadcast(known)
    id_type = docs.schema[id_col].dataType
    tail_type = T.ArrayType(T.StructType([T.StructField("_token", T.StringType()), T.StructField("_times", T.LongType())]))
    row_type = T.StructType([T.StructField("_id", id_type), T.StructField("_rid", T.LongType()), T.StructField("_bytes", T.LongType())])
    rows = written(
        docs.select(F.struct(col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_rid"),
                             F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("_bytes")).alias("_row"),
                    text.alias("_text"))
        .mapInArrow(_document_batches(head), T.StructType([
            T.StructField("_row", row_type), T.StructField("_sum", T.LongType()), T.StructField("_tail", tail_type)]))
        .select("_row.*", "_sum", "_tail"), "token-rows")
    rare = vocabulary.where((F.length("_token") > HEAD_CHARS) | (F.floor(F.log2("_times")) < least))
    tails = (rows.select("_rid", F.explode("_tail").alias("_t")).select("_rid", "_t._token", "_t._times")
             .join(rare.select("_token", "_pieces"), "_token")
             .groupBy("_rid").agg(F.sum(F.col("_times") * F.col("_pieces")).alias("_rest")))
    n = F.col("_sum") + F.coalesce("_rest", F.lit(0))
    return rows.drop("_tail").join(tails, "_rid", "left").select(
        F.col("_id").alias(id_col), F.col("_bytes").alias("n_bytes"), n.cast("long").alias("n_tokens"),
        (n > limit).alias("over_limit"))
