"""Word frequency and document cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.functions.text import clean_text, remove_stop_words, simple_tokens, whitespace_tokens
from sparkmill.operators.ordering import top_k_with_ties


def words(df: DataFrame, text_col: str = "text", mode: str = "raw") -> DataFrame:
    """One row per token, column ``word``.

    mode ``raw``: whitespace split, case kept; ``lower``: lower-cased first;
    ``clean``: punctuation deleted (a-z, 0-9 and whitespace kept) first.
    """
    text = F.col(text_col)
    if mode == "lower":
        text = F.lower(text)
    elif mode == "clean":
        text = clean_text(text)
    elif mode != "raw":
        raise ValueError(f"unknown mode {mode!r}")
    return df.select(F.explode(whitespace_tokens(text)).alias("word"))


def word_count(df: DataFrame, text_col: str = "text", mode: str = "raw") -> DataFrame:
    """(word, n): counts per token; partial aggregation runs before the shuffle,
    so a very common word costs one row per map task."""
    return words(df, text_col, mode).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, k: int = 20) -> DataFrame:
    """First ``k`` words by count, ties broken by the word (``TakeOrderedAndProject``)."""
    return counts.orderBy(F.col("n").desc(), F.col("word").asc()).limit(k)


def top_words_with_ties(counts: DataFrame, k: int = 10) -> DataFrame:
    """Every word whose count reaches the k-th largest count (ties all kept)."""
    return top_k_with_ties(counts, "n", k)


def clean_documents(df: DataFrame, stop_words: list[str], text_col: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """(id, text): delete punctuation, tokenise on non-word runs, drop stop
    words and join the remaining tokens with one space; order and repeats kept."""
    toks = remove_stop_words(simple_tokens(clean_text(F.col(text_col))), stop_words)
    return df.select(F.col(id_col), F.array_join(toks, " ").alias("text"))


def clean_documents_by_join(df: DataFrame, stop_words: DataFrame, text_col: str = "text",
                            id_col: str = "doc_id") -> DataFrame:
    """``clean_documents`` with the stop words in a table (word) of any length: an anti
    join on the tokens.  Rows are told apart by id and text; repeated rows stay."""
    toks = simple_tokens(clean_text(F.col(text_col)))
    rows = df.select(F.col(id_col), F.xxhash64(text_col).alias("_text"), toks.alias("_toks"))
    exploded = rows.dropDuplicates([id_col, "_text"]).select(id_col, "_text", F.posexplode("_toks").alias("_pos", "word"))
    kept = (exploded.join(stop_words.select("word").distinct(), "word", "left_anti")
            .groupBy(id_col, "_text").agg(F.sort_array(F.collect_list(F.struct("_pos", "word"))).alias("_kept")))
    kept = kept.select(F.col(id_col).alias("_id"), F.col("_text").alias("_key"), F.array_join("_kept.word", " ").alias("text"))
    out = rows.select(id_col, "_text", F.col("_toks").isNull().alias("_null")).join(
        kept, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key")), "left")
    return out.select(id_col, F.when(~F.col("_null"), F.coalesce("text", F.lit(""))).alias("text"))


def document_words(clean: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct (doc, word) pairs of cleaned documents (tokens split on single spaces,
    empty tokens dropped)."""
    toks = F.filter(F.split(F.col(text_col), " "), lambda t: t != F.lit(""))
    return clean.select(F.col(id_col).alias("doc"), F.explode(toks).alias("word")).distinct()
