"""The article backlog."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.functions import clean_text, strip
from marketframe.operators.news import (
    assemble_summaries,
    blank,
    explode_chunks,
    is_short,
    merge_summaries,
    pending,
    summarize_chunks,
    summarize_pending,
)
from marketframe.queries import tables as t
from marketframe.session import scratch_path
from marketframe.sources import read_collections
from marketframe.streaming import drain_collections, read_collections_drained, read_drained, stream_pending


def _lead_model():
    """A loader as a user writes it, standing in for a text model: the first two sentences of each text.

    It is a nested function, so that executors unpickle it without this package installed.
    """

    def load():
        return lambda texts: [". ".join(text.split(". ")[:2]) for text in texts]

    return load


# --- queries ----------------------------------------------------------------------------------


def articles_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections read as one; absent content reads as empty text."""
    paths = {"articles": scratch_path(spark, "articles"), "articles2": scratch_path(spark, "articles")}
    t.articles(spark, sf_dir).write.parquet(paths["articles"])
    t.page_articles(spark, sf_dir).write.parquet(paths["articles2"])
    return read_collections(spark, paths).select(
        "collection", "article_id", F.length("content").cast("bigint").alias("n_chars"), "summary"
    )


def articles_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending(t.articles(spark, sf_dir)).select("article_id", "summary")


def articles_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blank(t.articles(spark, sf_dir)).select("article_id")


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_text(F.col("content"))
    return t.articles(spark, sf_dir).select(
        "article_id", cleaned.alias("cleaned"), is_short(cleaned).alias("is_short"),
        strip(F.col("content")).alias("stripped"),
    )


def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_chunks(t.articles(spark, sf_dir)).withColumn("pos", F.col("pos").cast("bigint"))


def articles_summarized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize_pending(t.articles(spark, sf_dir))


def articles_summarized_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the Python plug-in: chunks, Arrow batches, ordered assembly, keyed update."""
    return summarize_pending(t.articles(spark, sf_dir), _lead_model())


def articles_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed update alone: labels say which articles get a new summary, toxic ones a null."""
    update = t.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("article_id"),
        F.when(F.col("toxic") == 0, F.concat(F.lit("quality "), "quality")).alias("summary"),
    )
    return merge_summaries(t.articles(spark, sf_dir), update).select("article_id", "summary")


def chunk_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model output per article before the update, for every article with enough text."""
    return assemble_summaries(summarize_chunks(explode_chunks(t.articles(spark, sf_dir)), _lead_model()))


def articles_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backlog drained by two incremental runs; the second finds only the second file as new."""
    source, out, state = (scratch_path(spark, n) for n in ("articles", "summaries", "state"))
    t.articles(spark, sf_dir).write.parquet(source)
    stream_pending(spark, source, out, state).awaitTermination()
    t.page_articles(spark, sf_dir).withColumn("article_id", -1 - F.col("article_id")).write.mode(
        "append"
    ).parquet(source)
    stream_pending(spark, source, out, state).awaitTermination()
    return read_drained(spark, out)


def _failing_model():
    def load():
        def summarize(texts):
            raise RuntimeError("model error")

        return summarize

    return load


def articles_streamed_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model fails in the first run; the second run, without new files, takes the articles up again."""
    source, out, state = (scratch_path(spark, n) for n in ("articles", "summaries", "state"))
    t.articles(spark, sf_dir).write.parquet(source)
    stream_pending(spark, source, out, state, _failing_model()).awaitTermination()
    stream_pending(spark, source, out, state, _lead_model()).awaitTermination()
    return read_drained(spark, out)


def collections_summarized_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections whose ids overlap, through one job with the model."""
    paths = {"articles": scratch_path(spark, "articles"), "articles2": scratch_path(spark, "articles")}
    t.articles(spark, sf_dir).write.parquet(paths["articles"])
    t.page_articles(spark, sf_dir).write.parquet(paths["articles2"])
    return summarize_pending(read_collections(spark, paths), _lead_model()).drop("content")


def collections_drained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections whose ids overlap, drained with keyed state.

    The model fails in the first run, which sees one collection; the second run sees both and tries the first one's
    articles again; before the third all files of the first collection land once more, unchanged.
    """
    paths = {"articles": scratch_path(spark, "articles"), "articles2": scratch_path(spark, "articles")}
    out, state = scratch_path(spark, "drained"), scratch_path(spark, "state")
    t.articles(spark, sf_dir).write.parquet(paths["articles"])
    t.page_articles(spark, sf_dir).limit(0).write.parquet(paths["articles2"])
    drain_collections(spark, paths, out, state, _failing_model()).awaitTermination()
    t.page_articles(spark, sf_dir).write.mode("append").parquet(paths["articles2"])
    drain_collections(spark, paths, out, state, _lead_model()).awaitTermination()
    t.articles(spark, sf_dir).write.mode("append").parquet(paths["articles"])
    drain_collections(spark, paths, out, state, _lead_model()).awaitTermination()
    return read_collections_drained(spark, out).drop("content")


QUERIES = {
    "articles_read": articles_read,
    "articles_pending": articles_pending,
    "articles_blank": articles_blank,
    "text_clean": text_clean,
    "text_chunks": text_chunks,
    "chunk_summaries": chunk_summaries,
    "articles_summarized": articles_summarized,
    "articles_summarized_by_model": articles_summarized_by_model,
    "articles_merged": articles_merged,
    "articles_streamed": articles_streamed,
    "articles_streamed_retry": articles_streamed_retry,
    "collections_summarized_by_model": collections_summarized_by_model,
    "collections_drained": collections_drained,
}

# --- expected results -------------------------------------------------------------------------

WHITE_SPACE_SQL = " || ".join(
    f"chr({code})" for code in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)


def _strip(text: str) -> str:
    return f"trim({text}, {WHITE_SPACE_SQL})"


def _is_blank(text: str) -> str:
    return f"({text} IS NULL OR {_strip(text)} = '')"


# fixed values: what is taken out of a text
BRACKETED_PATTERN = r"\([^\n]*?\)"
MARKS_PATTERN = r"""IQPlus,|"|“|”|‘|’|\(end\)"""


def _clean(text: str) -> str:
    unbracketed = f"regexp_replace({text}, '{BRACKETED_PATTERN}', '', 'g')"
    return _strip(f"regexp_replace({unbracketed}, '{MARKS_PATTERN}', '', 'g')")


def chunks_sql(texts: str, max_chars: int = 1000) -> str:
    """Sentence by sentence: ``article_id, pos, chunk`` of the relation ``texts (article_id, cleaned)``."""
    return f"""
    WITH RECURSIVE sentences AS (
        SELECT article_id, string_split(cleaned, '. ') AS parts FROM {texts}
    ), steps AS (
        SELECT article_id, 0 AS i, '' AS chunk, 0 AS pos, '' AS done, FALSE AS flushed FROM sentences
        UNION ALL
        SELECT s.article_id, i + 1,
               CASE WHEN length(chunk) + length(parts[i + 1]) < {max_chars} THEN chunk || parts[i + 1] || '. '
                    ELSE parts[i + 1] || '. ' END,
               CASE WHEN length(chunk) + length(parts[i + 1]) < {max_chars} THEN pos ELSE pos + 1 END,
               chunk, length(chunk) + length(parts[i + 1]) >= {max_chars}
        FROM steps s JOIN sentences USING (article_id) WHERE i < len(parts)
    )
    SELECT article_id, CAST(pos - 1 AS BIGINT) AS pos, {_strip('done')} AS chunk FROM steps WHERE flushed
    UNION ALL
    SELECT article_id, CAST(pos AS BIGINT), {_strip('chunk')}
    FROM (SELECT article_id, max(pos) AS pos, arg_max(chunk, i) AS chunk FROM steps GROUP BY 1)"""


def _summaries_sql(articles: str) -> str:
    """``article_id, summary`` of every article of the relation with at least 30 cleaned characters."""
    texts = f"""(SELECT article_id, {_clean('content')} AS cleaned FROM {articles}
                 WHERE NOT {_is_blank('content')} AND length({_clean('content')}) >= 30)"""
    return f"""
    SELECT article_id, string_agg(array_to_string(string_split(chunk, '. ')[1:2], '. '), ' ' ORDER BY pos) AS summary
    FROM ({chunks_sql(texts)}) WHERE chunk <> '' GROUP BY 1"""


def _summarized_sql(articles: str) -> str:
    return f"""
    SELECT a.article_id, content,
           CASE WHEN NOT {_is_blank('a.summary')} THEN a.summary WHEN {_is_blank('content')} THEN NULL
                WHEN length({_clean('content')}) < 30 THEN {_clean('content')} ELSE s.summary END AS summary
    FROM {articles} a LEFT JOIN ({_summaries_sql(articles)}) s ON a.article_id = s.article_id"""


PAGES_SQL = "SELECT page_id AS article_id, html AS content, CAST(NULL AS VARCHAR) AS summary FROM pages"

SUMMARIZED_SQL = f"WITH articles AS ({t.ARTICLES_SQL}) {_summarized_sql('articles')}"

COLLECTIONS_SUMMARIZED_SQL = f"""
    WITH articles AS ({t.ARTICLES_SQL}), others AS ({PAGES_SQL})
    SELECT 'articles' AS collection, article_id, summary FROM ({_summarized_sql('articles')})
    UNION ALL SELECT 'articles2', article_id, summary FROM ({_summarized_sql('others')})"""

ORACLES = {
    "articles_read": f"""
        SELECT 'articles' AS collection, article_id, length(coalesce(content, '')) AS n_chars, summary
        FROM ({t.ARTICLES_SQL})
        UNION ALL SELECT 'articles2', article_id, length(content), summary FROM ({PAGES_SQL})""",
    "articles_pending": f"SELECT article_id, summary FROM ({t.ARTICLES_SQL}) WHERE {_is_blank('summary')}",
    "articles_blank": f"SELECT article_id FROM ({t.ARTICLES_SQL}) WHERE {_is_blank('content')}",
    "text_clean": f"""SELECT article_id, {_clean('content')} AS cleaned,
        length({_clean('content')}) < 30 AS is_short, {_strip('content')} AS stripped FROM ({t.ARTICLES_SQL})""",
    "text_chunks": f"""WITH articles AS ({t.ARTICLES_SQL}) SELECT * FROM ({chunks_sql(
        f"(SELECT article_id, {_clean('content')} AS cleaned FROM articles "
        f"WHERE NOT {_is_blank('content')} AND length({_clean('content')}) >= 30)")})""",
    "chunk_summaries": f"WITH articles AS ({t.ARTICLES_SQL}) {_summaries_sql('articles')}",
    "articles_summarized": SUMMARIZED_SQL,
    "articles_summarized_by_model": SUMMARIZED_SQL,
    "articles_merged": f"""
        SELECT article_id, CASE WHEN l.doc_id IS NULL THEN summary WHEN l.toxic = 0 THEN concat('quality ', l.quality)
               END AS summary
        FROM ({t.ARTICLES_SQL}) a LEFT JOIN labels l ON a.article_id = l.doc_id""",
    "articles_streamed_retry": f"""
        WITH articles AS ({t.ARTICLES_SQL})
        SELECT article_id, coalesce(content, '') AS content, summary FROM ({_summarized_sql('articles')})""",
    "collections_summarized_by_model": COLLECTIONS_SUMMARIZED_SQL,
    "collections_drained": COLLECTIONS_SUMMARIZED_SQL,
    "articles_streamed": f"""
        WITH articles AS ({t.ARTICLES_SQL} UNION ALL SELECT -1 - page_id, html, NULL FROM pages)
        SELECT article_id, coalesce(content, '') AS content, summary FROM ({_summarized_sql('articles')})""",
}
