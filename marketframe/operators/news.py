"""The article backlog: what is pending, its chunks, their summaries and the keyed update."""

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.functions import chunk_text, clean_text, is_blank, join_in_order, lead_sentences
from marketframe.schemas import CHUNK_CHARS, SHORT_TEXT_CHARS

# takes the texts of a batch, gives one summary (or None) for each
Summarizer = Callable[[list[str]], list[str | None]]

# texts given to a model at a time, at most
MODEL_BATCH = 64


def pending(articles: DataFrame) -> DataFrame:
    """Articles without a summary, or with a blank one."""
    return articles.filter(is_blank(F.col("summary")))


def finished(articles: DataFrame) -> DataFrame:
    return articles.filter(~is_blank(F.col("summary")))


def blank(articles: DataFrame) -> DataFrame:
    """Articles without content: nothing to summarise."""
    return articles.filter(is_blank(F.col("content")))


def is_short(cleaned: Column) -> Column:
    """Cleaned text below this length stands as its own summary."""
    return F.length(cleaned) < SHORT_TEXT_CHARS


def key_columns(articles: DataFrame) -> list[str]:
    """What tells articles apart: their id, within their collection if there are several."""
    return [c for c in ("collection", "article_id") if c in articles.columns]


def _cleaned_content() -> Column:
    return F.when(~is_blank(F.col("content")), clean_text(F.col("content")))


def _chunks(cleaned: Column, max_chars: int) -> Column:
    return F.when(~is_short(cleaned), chunk_text(cleaned, max_chars))


def explode_chunks(articles: DataFrame, max_chars: int = CHUNK_CHARS) -> DataFrame:
    """Key columns, ``pos`` and ``chunk`` of the cleaned content, for articles that are not blank or short."""
    keys = key_columns(articles)
    cleaned = articles.select(*keys, _cleaned_content().alias("cleaned"))
    return cleaned.select(*keys, F.posexplode(_chunks(F.col("cleaned"), max_chars)).alias("pos", "chunk"))


def summarize_chunks(chunks: DataFrame, load: Callable[[], Summarizer], batch_size: int = MODEL_BATCH) -> DataFrame:
    """The rows of ``chunks`` with a ``summary`` of each chunk by a Python model, in place of the chunk.

    ``load`` returns the summariser and runs once per Python worker, however many tasks the worker gets.  A call
    gets at most ``batch_size`` texts.  If a call fails, or does not answer every text, its texts are tried one by
    one, and only those that fail get a null summary.  Rows whose chunk is null pass by.  Chunks are dealt
    out evenly first: the model's cost per chunk dwarfs the move, and long articles spread over many tasks.
    """
    token = uuid.uuid4().hex
    others = [c for c in chunks.columns if c != "chunk"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # lives in the worker process, so the next task finds it again
        loaded = sys.modules.setdefault("_marketframe_models", types.ModuleType("_marketframe_models")).__dict__
        if token not in loaded:
            loaded[token] = load()
        summarizer = loaded[token]

        def call(texts):
            answers = summarizer(texts)
            if len(answers) != len(texts):
                raise ValueError("the model did not answer every text")
            return list(answers)

        def one(text):
            try:
                return call([text])[0]
            except Exception:
                return None

        def many(texts):
            try:
                return call(texts)
            except Exception:
                return [one(text) for text in texts]

        for batch in batches:
            chunks_here = batch["chunk"].tolist()
            given = [i for i, chunk in enumerate(chunks_here) if isinstance(chunk, str)]
            summaries = [None] * len(batch)
            for start in range(0, len(given), batch_size):
                part = given[start : start + batch_size]
                for i, summary in zip(part, many([chunks_here[i] for i in part])):
                    summaries[i] = summary
            yield batch[others].assign(summary=pd.Series(summaries, index=batch.index, dtype=object))

    fields = ", ".join(f"`{c}` {chunks.schema[c].dataType.simpleString()}" for c in others)
    return (
        chunks.filter(F.coalesce(F.col("chunk") != "", F.lit(True)))
        .repartition(*key_columns(chunks), "pos")
        .mapInPandas(run, schema=f"{fields}, summary string")
    )


def assemble_summaries(chunk_summaries: DataFrame) -> DataFrame:
    """Chunk summaries joined per article in chunk order; "" when every chunk failed.

    A group holds the chunks of one article, which came out of a single row and fit into one again.
    """
    return chunk_summaries.groupBy(*key_columns(chunk_summaries)).agg(
        join_in_order(F.col("pos"), F.col("summary")).alias("summary")
    )


def merge_summaries(articles: DataFrame, summaries: DataFrame, version: str | None = None) -> DataFrame:
    """Articles with their summary replaced where ``summaries`` has a row for the key, even a null one.

    Of several rows for one key that with the greatest ``version`` counts; without a version the greatest
    summary, a null one only if there is no other.
    """
    keys = [c for c in key_columns(articles) if c in summaries.columns]
    latest = F.max_by("summary", version) if version else F.max("summary")
    new = summaries.groupBy(*keys).agg(latest.alias("_new")).withColumn("_hit", F.lit(True))
    summary = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("summary"))
    return articles.join(new, keys, "left").withColumn("summary", summary).select(*articles.columns)


def summarize_text(cleaned: Column, max_chars: int = CHUNK_CHARS, sentences: int = 2) -> Column:
    """Native summary of a cleaned text: lead sentences of each chunk; short text stands as it is."""
    leads = F.transform(
        F.filter(chunk_text(cleaned, max_chars), lambda chunk: chunk != ""),
        lambda chunk: lead_sentences(chunk, sentences),
    )
    return F.when(is_short(cleaned), cleaned).otherwise(F.array_join(leads, " "))


def summarize_pending(
    articles: DataFrame, load: Callable[[], Summarizer] | None = None, batch_size: int = MODEL_BATCH
) -> DataFrame:
    """The whole article table with every pending article summarised; finished ones stay as they are.

    Without a model these are projections: no shuffle, no Python.  Cleaning is a projection of its own,
    whose result Spark computes once per article although it is used several times.  With a model, only
    pending articles go through chunking, the model and the keyed update; finished articles pass by
    unshuffled.
    """
    if load is None:
        is_pending = is_blank(F.col("summary"))
        return (
            articles.withColumn("_cleaned", F.when(is_pending, _cleaned_content()))
            .withColumn(
                "summary", F.when(is_pending, summarize_text(F.col("_cleaned"))).otherwise(F.col("summary"))
            )
            .drop("_cleaned")
        )
    # cleaned once: a row per chunk, and one without a chunk for articles whose text stands as it is
    keys = key_columns(articles)
    backlog = pending(articles)
    cleaned = backlog.select(*keys, _cleaned_content().alias("cleaned"))
    short = F.when(is_short(F.col("cleaned")), F.col("cleaned")).alias("short")
    pieces = cleaned.select(*keys, short, F.posexplode_outer(_chunks(F.col("cleaned"), CHUNK_CHARS)).alias("pos", "chunk"))
    summaries = summarize_chunks(pieces, load, batch_size)
    chunked = F.max(F.col("pos").isNotNull())
    assembled = summaries.groupBy(*keys).agg(
        F.when(chunked, join_in_order(F.col("pos"), F.col("summary"))).otherwise(F.max("short")).alias("summary")
    )
    return finished(articles).unionByName(merge_summaries(backlog, assembled))
