"""Requirement sections to structured requirements."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.fixed_values import (
    CERTIFICATION,
    DROPPED_LIST_VALUES,
    FAILED,
    SKIPPED,
    TECHNICAL_CONCEPT,
    TECHNICAL_TOOL,
    VALIDATED,
)
from jobtide.functions.requirements import (
    LIST_FIELDS,
    YEAR_FIELDS,
    clean_list,
    holds_text_only,
    max_years,
    min_years,
    phrases,
    tokens,
    variant_items,
    variant_kind,
    whole_number,
)
from jobtide.functions.sections import with_requirement_section
from jobtide.functions.text import strip, valid_json, with_computed
from jobtide.functions.titles import infer_seniority
from jobtide.schemas import KEY
from jobtide.session import computed_once

MAX_INLINE_TERMS = 500
# Gazetteer rows that may be broadcast to meet the phrases.
BROADCAST_TERMS = 500_000
# Shares of a common phrase, where phrases and terms are shuffled.
PHRASE_SALTS = 16

_FIELD_OF_TYPE = {
    TECHNICAL_TOOL: "technical_tools",
    TECHNICAL_CONCEPT: "technical_concepts",
    CERTIFICATION: "certifications",
}


# The tokens of a term, as ``functions.requirements.TOKEN`` finds them.
_TOKEN = re.compile(r"\n|\.?\w[\w+#]*")


@dataclass(frozen=True)
class Term:
    term: str
    item_type: str
    canonical: str


def terms_frame(spark: SparkSession, terms: Sequence[Term]) -> DataFrame:
    rows = [(t.term, t.item_type, t.canonical) for t in terms]
    return spark.createDataFrame(rows, "term string, item_type string, canonical string")


def phrase_index(terms: DataFrame) -> DataFrame:
    """Gazetteer rows with the term spelled as the phrase it is looked up by."""
    return terms.withColumn("phrase", F.array_join(tokens(F.col("term")), " ")).withColumn(
        "n_words", F.size(tokens(F.col("term")))
    )


def small_gazetteer(terms: DataFrame | Sequence[Term]) -> list[tuple[str, int, str, str]] | None:
    """``(phrase, n_words, item_type, canonical)`` if few enough to become an expression.

    At most ``MAX_INLINE_TERMS + 1`` rows reach the driver, whatever the table holds.
    """
    if isinstance(terms, DataFrame):
        index = phrase_index(terms).filter("n_words > 0")
        rows = index.select("phrase", "n_words", "item_type", "canonical").limit(MAX_INLINE_TERMS + 1).collect()
        head = [tuple(row) for row in rows]
    else:
        spelled = [(_TOKEN.findall(t.term.lower()), t) for t in terms]
        head = [(" ".join(words), len(words), t.item_type, t.canonical) for words, t in spelled if words]
    return head if len(head) <= MAX_INLINE_TERMS else None


def with_terms(df: DataFrame, text_col: str, terms: DataFrame | Sequence[Term]) -> DataFrame:
    """Add the sorted lists of tools, concepts and certifications a text names.

    A term counts when all its words stand next to each other on one line.  A
    gazetteer of up to ``MAX_INLINE_TERMS`` becomes an expression (no shuffle);
    a larger one is joined to the phrases of the texts.
    """
    head = small_gazetteer(terms)
    if head is None:
        frame = terms if isinstance(terms, DataFrame) else terms_frame(df.sparkSession, terms)
        return with_terms_by_join(df, text_col, frame)
    staged = with_computed(df, _line=F.concat(F.lit(" "), F.array_join(tokens(F.col(text_col)), " "), F.lit(" ")))
    for item_type, field in _FIELD_OF_TYPE.items():
        names: dict[str, list[str]] = {}
        for phrase, _, kind, canonical in head:
            if kind == item_type:
                names.setdefault(phrase, []).append(canonical)
        staged = staged.withColumn(field, _inline_hits(F.col("_line"), names))
    return staged.drop("_line")


def _inline_hits(line: Column, names: dict[str, list[str]]) -> Column:
    """Sorted names of the phrases that stand in ``line``: tokens with one space before, between and after them.

    No token holds a space, so a phrase between spaces is a run of whole tokens; the runs of a text are not listed.
    """
    if not names:
        return F.array().cast("array<string>")
    known = F.array(*[F.lit(f" {p} ") for p in names])
    canonical = F.create_map(
        *[x for p, cs in names.items() for x in (F.lit(f" {p} "), F.array(*[F.lit(c) for c in cs]))]
    )
    hits = F.transform(F.filter(known, lambda p: F.contains(line, p)), lambda p: F.element_at(canonical, p))
    return F.array_sort(F.array_distinct(F.flatten(hits)))


def with_terms_by_join(df: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """``with_terms`` for a gazetteer of any size; every row is on its own, whatever its columns hold.

    The rows are read once: each is opened into its phrases, the first of which
    carries the row, and closed again by a row number.  A gazetteer too large to
    broadcast meets the phrases in salted shares, so that a common phrase is not
    one task's.
    """
    index = phrase_index(terms).filter("n_words > 0").select("phrase", "item_type", "canonical", "n_words").distinct()
    n_terms, longest = index.agg(F.count(F.lit(1)), F.coalesce(F.max("n_words"), F.lit(1))).first()
    index = index.drop("n_words")
    numbered = df.select(F.struct(*df.columns).alias("_whole"), F.monotonically_increasing_id().alias("_row"), text_col)
    # Stored with their numbers: a task that is lost later gives a row no other number than before.
    numbered = computed_once(numbered)
    staged = with_computed(numbered, _words=tokens(F.col(text_col))).drop(text_col)
    opened = staged.select("_row", "_whole", F.posexplode_outer(phrases(F.col("_words"), longest)).alias("_at", "phrase"))
    first = F.coalesce(F.col("_at"), F.lit(0)) == 0
    opened = opened.select("_row", F.when(first, F.col("_whole")).alias("_whole"), "phrase")
    if n_terms <= BROADCAST_TERMS:
        met = opened.join(F.broadcast(index), "phrase", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(PHRASE_SALTS - 1)))
        shares = index.withColumn("_salt", salts)
        salted = opened.withColumn("_salt", F.pmod(F.xxhash64("_row", "phrase"), F.lit(PHRASE_SALTS)).cast("int"))
        met = salted.join(shares, ["phrase", "_salt"], "left")
    closed = met.groupBy("_row").agg(
        F.first("_whole", ignorenulls=True).alias("_whole"),
        *[
            F.array_sort(F.collect_set(F.when(F.col("item_type") == item_type, F.col("canonical")))).alias(field)
            for item_type, field in _FIELD_OF_TYPE.items()
        ],
    )
    return closed.select("_whole.*", *LIST_FIELDS)


def with_years(df: DataFrame, text_col: str) -> DataFrame:
    """Add the least ``min_years`` and the greatest ``max_years`` a text asks for."""
    text = F.col(text_col)
    return df.withColumn("min_years", min_years(text)).withColumn("max_years", max_years(text))


def parse_responses(
    responses: DataFrame, response_col: str = "response", dropped: Iterable[str] = DROPPED_LIST_VALUES
) -> DataFrame:
    """Validate structured answers; the answer column is replaced by its fields.

    Adds ``extraction_status``, ``error``, the three lists and the two years.
    Missing lists are empty, missing years null; whole numbers may come as text
    or as ``5.0``.  A wrong type in any field fails the whole record, and so does
    text after the answer.  ``dropped`` are the placeholders that no list keeps.
    """
    dropped = list(dropped)
    kept = [c for c in responses.columns if c != response_col]
    response = F.col(response_col)
    parsed = with_computed(responses, _value=F.when(valid_json(response), F.try_parse_json(response)))
    value = F.col("_value")
    fields = with_computed(
        parsed,
        _blank=F.coalesce(strip(response), F.lit("")) == "",
        _object=F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False)),
        **{f"_kind_{f}": variant_kind(value, f) for f in (*LIST_FIELDS, *YEAR_FIELDS)},
        **{f"_{f}": variant_items(value, f) for f in LIST_FIELDS},
        **{f"_{f}": whole_number(F.get_json_object(response, f"$.{f}")) for f in YEAR_FIELDS},
    )
    absent = {f: F.col(f"_kind_{f}") == "VOID" for f in (*LIST_FIELDS, *YEAR_FIELDS)}
    problems = F.concat_ws(
        "; ",
        *[
            F.when(~absent[f] & ~holds_text_only(F.col(f"_{f}")), F.lit(f"{f} is not a list of text"))
            for f in LIST_FIELDS
        ],
        *[F.when(~absent[f] & F.col(f"_{f}").isNull(), F.lit(f"{f} is not a whole number")) for f in YEAR_FIELDS],
    )
    judged = with_computed(
        fields,
        error=F.when(F.col("_blank"), "Missing requirement text")
        .when(~F.col("_object"), "response is not a JSON object")
        .otherwise(F.nullif(problems, F.lit(""))),
    )
    valid = F.col("error").isNull()
    texts = {f: F.transform(F.col(f"_{f}"), lambda v: v.try_cast("string")) for f in LIST_FIELDS}
    return judged.select(
        *kept,
        F.when(F.col("_blank"), SKIPPED).when(valid, VALIDATED).otherwise(FAILED).alias("extraction_status"),
        "error",
        *[clean_list(F.when(valid, texts[f]), dropped).alias(f) for f in LIST_FIELDS],
        *[F.when(valid, F.col(f"_{f}")).alias(f) for f in YEAR_FIELDS],
    )


def clean_requirement_lists(requirements: DataFrame) -> DataFrame:
    for field in LIST_FIELDS:
        requirements = requirements.withColumn(field, clean_list(F.col(field)))
    return requirements


def job_descriptions(jobs: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Curated jobs with the html of their description."""
    html = descriptions.select(*KEY, "html_description")
    return jobs.select(*KEY, "job_title", "role_title").join(html, KEY)


def _finish(extracted: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Status, seniority and column order shared by both ways of extraction."""
    return extracted.withColumn("seniority", infer_seniority(F.col("job_title"), F.col("min_years"))).select(
        *KEY,
        *LIST_FIELDS,
        "min_years",
        "max_years",
        "seniority",
        "extraction_status",
        "error",
        *also,
    )


def build_requirements(described: DataFrame, terms: DataFrame | Sequence[Term], also: Sequence[str] = ()) -> DataFrame:
    """One requirements row per described job, from the gazetteer; ``also``: columns of the job to carry along.

    The page is cut down to its section before anything is looked up in it.  A
    job without section text is kept as skipped, with empty lists.
    """
    sections = with_requirement_section(described, "html_description", "_section").drop("html_description")
    found = with_years(with_terms(sections, "_section", terms), "_section")
    missing = F.col("_section") == ""
    return _finish(
        found.withColumn("extraction_status", F.when(missing, SKIPPED).otherwise(VALIDATED)).withColumn(
            "error", F.when(missing, "No requirement section extracted")
        ),
        also,
    )


def build_requirements_from_model(
    described: DataFrame, answer: Callable[[pd.Series], pd.Series], dropped: Iterable[str] = DROPPED_LIST_VALUES
) -> DataFrame:
    """One requirements row per described job, from the user's own model.

    ``answer`` turns a batch of section texts into a batch of JSON answers.  It
    runs inside the tasks, sees only texts that are not empty, and its answers
    are validated like any other response.
    """
    sections = with_requirement_section(described, "html_description", "section").drop("html_description")
    columns = sections.columns

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = batch["section"].str.strip() != ""
            batch["response"] = None
            if asked.any():
                batch.loc[asked, "response"] = answer(batch.loc[asked, "section"])
            yield batch[[*columns, "response"]]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sections.schema.fields)
    answered = parse_responses(sections.mapInPandas(ask, f"{schema}, response string"), dropped=dropped)
    no_section = F.col("section") == ""
    return _finish(answered.withColumn("error", F.when(no_section, "No requirement section extracted").otherwise(F.col("error"))))


def extraction_backlog(jobs: DataFrame, requirements: DataFrame) -> DataFrame:
    """Jobs that still lack a validated requirements row."""
    done = requirements.filter(F.col("extraction_status") == VALIDATED).select(*KEY)
    return jobs.join(done, KEY, "left_anti")
