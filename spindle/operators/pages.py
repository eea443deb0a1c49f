"""Documents in pages of about 500 words, and the pages where a concept is discussed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE_WORDS, BEST_PAGES, LONG_FROM = 500, 3, 3

#: Words that show where a document answers a question about its dataset (fixed values).
CONCEPTS = {
    "study.description": ["background", "introduction", "population", "setting", "study design", "purpose"],
    "study.main_question": ["primary objective", "main objective", "primary outcome", "research question", "aim"],
    "study.secondary_questions": ["secondary objective", "secondary outcome", "specific objectives"],
    "study.study_type": ["cohort", "cross-sectional", "surveillance", "registry", "trial", "survey", "routine"],
    "unit_of_analysis.one_row_is": ["unit of analysis", "data collection", "case report form", "record", "each row"],
    "unit_of_analysis.main_event": ["visit", "encounter", "admission", "episode", "test", "specimen"],
    "codes_and_vocabularies": ["icd", "code list", "coding", "vocabulary", "loinc", "who stage", "regimen"],
    "privacy": ["confidential", "identifier", "anonymi", "de-identif", "consent", "privacy", "pseudonym"],
    "dataset.period_covered": ["study period", "between", "enrolment period", "data collection period"],
}


def page_texts(text: Column, words: int = PAGE_WORDS) -> Column:
    """The pages of a text: ``words`` blank-separated words each, one empty page at least."""
    cut = F.regexp_extract_all(text, F.lit(rf"(?:[ \r\n]*[^ \r\n]+){{1,{words}}}"), F.lit(0))
    return F.when(F.size(cut) == 0, F.array(text)).otherwise(cut)


def pages(docs: DataFrame, id_col: str, text_col: str, words: int = PAGE_WORDS) -> DataFrame:
    """``id_col, page, text``: pages from 1 on, of ``words`` blank-separated words each.

    A page keeps the line breaks between its words.  A text without words is one page; a null
    text is empty; rows with a null or repeated id have pages like any other."""
    cut = page_texts(F.coalesce(F.col(text_col), F.lit("")), words)
    rows = docs.select(id_col, F.posexplode(cut).alias("page", "text"))
    return rows.select(id_col, (F.col("page") + 1).alias("page"), F.btrim("text", F.lit(" \r\n")).alias("text"))


def concept_scores(paged: DataFrame, id_col: str, concepts: Mapping[str, Sequence[str]] = CONCEPTS) -> DataFrame:
    """``id_col, page, concept, score``: how often a page holds a concept's words."""
    low = F.lower("text")
    times = lambda w: ((F.length(low) - F.length(F.replace(low, F.lit(w), F.lit("")))) / len(w)).cast("int")
    each = [F.struct(F.lit(c).alias("concept"), sum((times(w) for w in words), F.lit(0)).alias("score")) for c, words in concepts.items()]
    rows = paged.select(id_col, "page", F.explode(F.array(*each)).alias("s"))
    return rows.select(id_col, "page", "s.concept", "s.score").where("score > 0")


def concept_pages(docs: DataFrame, id_col: str, text_col: str, best: int = BEST_PAGES, concepts: Mapping[str, Sequence[str]] = CONCEPTS) -> DataFrame:
    """The ``best`` pages of each document for each concept; ties go to earlier pages."""
    order = Window.partitionBy(id_col, "concept").orderBy(F.desc("score"), "page")
    scored = concept_scores(pages(docs, id_col, text_col), id_col, concepts)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def document_summary(docs: DataFrame, id_col: str, text_col: str, words: int = PAGE_WORDS) -> DataFrame:
    """``id_col, pages, words, long`` of every row, in one projection; long documents have more
    than ``LONG_FROM`` pages.  A null text is empty: one page, no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaced = F.size(F.regexp_extract_all(text, F.lit(r"[^ \r\n]+"), F.lit(0)))
    size = F.size(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0)))
    count = F.greatest(F.lit(1), F.ceil(spaced / F.lit(words))).cast("int")
    return docs.select(id_col, count.alias("pages"), size.alias("words"), (count > LONG_FROM).alias("long"))
