import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.checks.fixtures import PREFIXES, ROLES, TITLES
from jobtide.functions import titles as T
from jobtide.operators import roles as R

CASES = {
    # one line per rule: title -> after bilingual terms
    T.normalize_bilingual: [
        ("DATA Engineer", "data engineer"),
        ("Ingénieur QA", "engineer qa"),
        ("Spécialiste Tête", "specialiste tête"),
        ("expert ia senior", "expert ai senior"),
        ("ia expert", "ia expert"),
        ("un ia ia deux", "un ai ia deux"),
        ("Développeur(euse) Web", "developer web"),
        ("Conseiller·e", "conseiller"),
        ("Analyste(-euse)", "analyste"),
        ("Ingénieur logiciel", "software engineer"),
        ("Ingénierie logiciel", "software engineer"),
        ("Architecte de données", "data engineer"),
        ("Développement de logiciel", "software developer"),
        ("Science des données", "data scientist"),
        ("Scientifique de données", "data scientist"),
        ("Analyste de données", "analyste data"),
        ("Python Dev", "pythondeveloper"),
        ("Stage en finance", "internship finance"),
        ("backstage crew", "backinternship crew"),
        ("  x ", "x"),
    ],
    T.remove_seniority: [
        ("senior data engineer", "data engineer"),
        ("engineer, senior", "engineer,"),
        ("sr. data engineer", "data engineer"),
        ("jr data analyst", "data analyst"),
        ("new graduate engineer", "engineer"),
        ("rotational program analyst", "analyst"),
        ("international sales", "international sales"),
        ("123 - engineer", "engineer"),
        ("data   engineer", "data engineer"),
    ],
    T.normalize_common_terms: [
        ("prompt engineer", "ai developer"),
        ("software development", "software developer"),
        ("software dev lead", "software developerlead"),
        ("swe backend", "software engineer backend"),
        ("ai/ml researcher", "ai researcher"),
        ("artificial intelligence lead", "ai lead"),
        ("python developer", "software developer"),
        ("internet developer", "intersoftware developer"),
        ("c#/.net developer", "software developer"),
        ("node.js developers", "software developers".replace("developers", "developer")),
        ("c sharp developer", "software developer"),
        ("machine learning engineers", "machine learning engineer"),
        ("web development", "web developer"),
    ],
}


@pytest.mark.parametrize("step", list(CASES), ids=lambda f: f.__name__)
def test_rules(spark, step):
    df = spark.createDataFrame(CASES[step], "title string, expected string")
    wrong = df.withColumn("got", step(F.col("title"))).filter("got <> expected").collect()
    assert wrong == []


def test_clean_title(spark):
    cases = [
        ("Senior Data Engineer", "data engineer"),
        (None, ""),
        ("", ""),
        ("Développeur(euse) logiciel", "software developer"),
        ("Analyste de données", "analyste data"),
        ("New Grad Software Development Engineer", "software developer engineer"),
    ]
    df = spark.createDataFrame(cases, "title string, expected string")
    assert T.with_clean_title(df, "title").filter("cleaned_title <> expected").collect() == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aeinrsédv .(),/+#-·'", max_size=30), min_size=50, max_size=80))
def test_rule_chain_agrees_with_plain_regular_expressions(spark, texts):
    """The guarded chain in Java gives what the plain rules give in Python."""
    texts = texts + [a + b for a in PREFIXES.split("|") for b in TITLES.split("|")]

    def plain(text):
        for pattern, replacement in V.BILINGUAL_RULES:
            text = re.sub(pattern, replacement, text)
        return text

    df = spark.createDataFrame([(t.lower(),) for t in texts], "t string")
    got = {r.t: r.x for r in df.select("t", T.rewrite(F.col("t"), V.BILINGUAL_RULES).alias("x")).collect()}
    assert got == {t: plain(t) for t in got}


def mapped(df):
    return {r.title: (r.matched_role, r.match_method) for r in df.collect()}


MAPPED = {
    "Senior Data Engineer": ("data engineer", V.EXACT_MATCH),
    "Engineer of Data Platforms": ("data engineer", V.FLEXIBLE_MATCH),
    "Databricks Lead": ("data engineer", V.KEYWORD_MATCH),
    "Generative AI Consultant": ("ai developer", V.KEYWORD_MATCH),
    "Data Engineer / Data Analyst": ("data engineer", V.EXACT_MATCH),
    "Lead (ml)": (None, V.NO_MATCH),
    "Lead (ml ops)": ("ml engineer", V.KEYWORD_MATCH),
    "Expert, nlp": ("ml engineer", V.KEYWORD_MATCH),
    "Cook": (None, V.NO_MATCH),
    None: (None, V.NO_MATCH),
    "": (None, V.NO_MATCH),
}


def test_map_titles_both_ways(spark):
    df = spark.createDataFrame([(t,) for t in MAPPED], "title string")
    assert mapped(R.map_titles(df, ROLES)) == MAPPED
    assert mapped(R.map_titles(df, R.taxonomy_frame(spark, ROLES))) == MAPPED
    assert mapped(R.map_titles_by_join(df, R.taxonomy_frame(spark, ROLES))) == MAPPED


def test_large_taxonomy_is_joined(spark):
    """More aliases than fit an expression: same answers as brute force, hot words included."""
    many = [R.Role(f"role {i}", (f"engineer level {i}", f"x{i} engineer")) for i in range(400)]
    assert R.small_taxonomy(R.taxonomy_frame(spark, many)) is None
    titles = [f"engineer of x{i}" for i in range(0, 400, 7)] + ["engineer", "level 3 engineer"]
    rows = [(t,) for t in titles] + [("x5 engineer",)] * 500
    out = R.map_titles(spark.createDataFrame(rows, "title string"), R.taxonomy_frame(spark, many))
    expected = {f"engineer of x{i}": (f"role {i}", V.FLEXIBLE_MATCH) for i in range(0, 400, 7)}
    expected |= {
        "engineer": (None, V.NO_MATCH),
        "level 3 engineer": ("role 3", V.FLEXIBLE_MATCH),
        "x5 engineer": ("role 5", V.EXACT_MATCH),
    }
    assert mapped(out) == expected
    assert out.count() == len(rows)


def test_hot_title_is_spread_and_stays_whole(spark):
    """A title with a third of the rows is split over copies of its match."""
    rows = [(i, "data engineer") for i in range(1000)] + [(i, f"cook {i}") for i in range(1000, 3000)]
    df = spark.createDataFrame(rows, "id int, title string")
    out = R.map_titles_by_join(df, R.taxonomy_frame(spark, ROLES), hot_rows=100)
    assert out.count() == 3000 and out.select("id").distinct().count() == 3000
    assert out.filter(f"match_method = '{V.EXACT_MATCH}'").count() == 1000


def test_aliases_of_symbols_and_map_columns_both_ways(spark):
    roles = [R.Role("plus", ("++",)), R.Role("cook", ("head cook", "")), R.Role("amp", (" & ",))]
    rows = [("a++b", {"x": 1}), ("a+++b", None), ("cook of the head", None), ("r & d", None), ("", None), (None, None), ("++", None)]
    df = spark.createDataFrame(rows, "title string, more map<string,int>")
    frame = R.taxonomy_frame(spark, roles)
    shown = lambda d: sorted(((r.title, r.matched_role, r.match_method) for r in d.collect()), key=str)
    inline, joined = R.map_titles(df, roles), R.map_titles_by_join(df, frame)
    assert shown(inline) == shown(joined) and joined.columns == inline.columns
    assert ("a++b", "plus", V.EXACT_MATCH) in shown(joined)


def test_rows_without_a_title_are_spread(spark):
    df = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('title ', id % 50) END AS title")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = R.map_titles_by_join(df, R.taxonomy_frame(spark, ROLES)).filter("title IS NULL")
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 10_000 and len(sizes) > 4 and max(sizes) < 4_000


def test_role_without_aliases_never_matches(spark):
    df = spark.createDataFrame([("anything",)], "title string")
    assert mapped(R.map_titles(df, [R.Role("empty", ())])) == {"anything": (None, V.NO_MATCH)}


def test_mapping_is_one_row_per_title_at_any_partitioning(frames):
    one = R.map_titles(frames.titles.repartition(1), ROLES)
    many = R.map_titles(frames.titles.repartition(64), ROLES)
    assert one.count() == frames.titles.count()
    assert one.exceptAll(many).isEmpty()


def test_seniority(spark):
    cases = [
        ("International Sales", None, "junior"),
        ("Data Engineer", 2, "junior"),
        ("Data Engineer", 3, "mid"),
        ("Data Engineer", 5, "senior"),
        ("Data Engineer", None, None),
        ("Senior Associate", None, "junior"),
        ("Team Lead", 1, "senior"),
        (None, None, None),
    ]
    df = spark.createDataFrame(cases, "title string, years int, expected string")
    got = df.withColumn("got", T.infer_seniority(F.col("title"), F.col("years")))
    assert got.filter("not (got <=> expected)").collect() == []


def test_filter_on_role_does_not_repeat_the_rules(frames):
    """The costly expression stands in the plan once, below the filter."""
    plan = R.mapped_only(R.map_titles(frames.titles, ROLES))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("stagaire") == 2  # the guard and the rule itself


def test_tokens_stand_where_the_pattern_finds_the_alias(spark):
    import random

    from jobtide.operators.roles import holds_tokens, tokens_of

    rng = random.Random(11)
    marks = ["a", "B", "ab", "é", "1", "_", " ", "-", "+", "+", ".", " ", "/", "#"]
    rows = [("".join(rng.choices(marks, k=rng.randrange(12))), "".join(rng.choices(marks, k=rng.randrange(1, 5)))) for _ in range(6000)]
    df = spark.createDataFrame(rows, "title string, alias string")
    pattern = F.concat(F.lit(r"(?iU)\b\Q"), F.col("alias"), F.lit(r"\E\b"))
    both = df.select("title", "alias", F.rlike("title", pattern).alias("a"), holds_tokens(tokens_of(F.col("title")), tokens_of(F.col("alias"))).alias("b"))
    assert both.filter("a <> b").collect() == []
    assert both.filter("a").count() > 200


def test_a_hundred_thousand_aliases(spark):
    """No pattern per row, and no title meets all aliases."""
    from jobtide.operators.roles import map_titles_by_join

    roles = [(i, f"role {i}", [f"Kind{i} of Work", f"worker {i} night-shift"], []) for i in range(50_000)]
    taxonomy = spark.createDataFrame(roles, "position int, name string, aliases array<string>, search_term array<string>").repartition(8)
    titles = [(i, f"kind{i} of work" if i % 2 else f"night-shift worker {i}") for i in range(0, 50_000, 25)]
    df = spark.createDataFrame([*titles, (-1, "kind of work"), (-2, None)], "id int, title string")
    mapped = map_titles_by_join(df, taxonomy)
    plan = mapped._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "\\Q" not in plan
    got = {r.id: (r.matched_role, r.match_method) for r in mapped.collect()}
    assert len(got) == len(titles) + 2
    for i, title in titles:
        assert got[i][0] == f"role {i}", title


def test_joined_titles_are_cleaned_once(spark):
    """The rules work on distinct titles, before the rows are met; rows stay whole, hot, blank or without a title."""
    titles = ["Senior Data Engineer", "senior  data engineer", "Senior", "", None, "\u00005", "12", "Cook", "Data Analyst"]
    rows = [(i, titles[i % len(titles)], "x") for i in range(900)]
    df = spark.createDataFrame(rows, "id int, title string, match_method string")
    plain = R.map_titles(df.drop("match_method"), ROLES)
    for hot_rows in (30, 1000):
        out = R.map_titles_by_join(df, R.taxonomy_frame(spark, ROLES), hot_rows=hot_rows)
        assert "stagaire" not in out._jdf.queryExecution().optimizedPlan().toString()
        out = R.map_titles_by_join(df.drop("match_method"), R.taxonomy_frame(spark, ROLES), hot_rows=hot_rows)
        assert out.columns == plain.columns and out.count() == 900
        assert out.exceptAll(plain).isEmpty()
