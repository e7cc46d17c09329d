import json

from pyspark.sql import functions as F

from jobtide.checks.fixtures import TERMS
from jobtide.fixed_values import DROPPED_LIST_VALUES, PLACEHOLDER_VALUES
from jobtide.functions import requirements as Q
from jobtide.operators import requirements as R
from jobtide.operators.items import requirement_items

TEXTS = {
    1: ("Python, SQL; C++ and .NET", ["C++", ".NET", "Python", "SQL"], [], []),
    2: ("machine\nlearning", [], [], []),
    3: ("Machine  learning and AWS Certified Developer", ["AWS"], ["machine learning"], ["AWS Certified Developer"]),
    4: ("pythonic sqlite awsome", [], [], []),
    5: ("", [], [], []),
    6: (None, [], [], []),
    7: ("node.js, Node.JS", ["Node.js"], [], []),
    8: ("python " * 3000 + "etl", ["Python"], ["ETL"], []),
}


def _texts(spark):
    return spark.createDataFrame([(k, v[0]) for k, v in TEXTS.items()], "id int, text string")


def _found(df):
    return {
        r.id: (sorted(r.technical_tools), sorted(r.technical_concepts), sorted(r.certifications)) for r in df.collect()
    }


def test_terms_both_ways(spark):
    expected = {k: tuple(sorted(x) for x in v[1:]) for k, v in TEXTS.items()}
    terms = R.terms_frame(spark, TERMS)
    assert _found(R.with_terms(_texts(spark), "text", terms)) == expected
    assert _found(R.with_terms(_texts(spark), "text", TERMS)) == expected
    assert _found(R.with_terms_by_join(_texts(spark), "text", terms)) == expected


def test_large_gazetteer_is_joined(spark):
    many = [R.Term(f"tool{i} suite", "technical_tool", f"Tool {i}") for i in range(2000)]
    df = R.with_terms(_texts(spark).limit(0).unionByName(
        spark.createDataFrame([(1, "we use tool7 suite and tool1999 suite, tool5")], "id int, text string")
    ), "text", many)
    assert R.small_gazetteer(many) is None and R.small_gazetteer(R.terms_frame(spark, many)) is None
    assert df.first().technical_tools == ["Tool 1999", "Tool 7"]


def test_terms_take_each_row_on_its_own_both_ways(spark):
    """Rows that share an id, a row without one, a map column: the same answers in both forms."""
    rows = [(1, "python", {"a": 1}), (1, "sql", None), (None, "python and sql", {}), (2, None, None), (2, "", None)]
    df = spark.createDataFrame(rows, "id int, text string, more map<string,int>")
    terms = [R.Term("python", "technical_tool", "Python"), R.Term("sql", "technical_tool", "SQL")]
    frame = R.terms_frame(spark, terms * 2)
    want = sorted([(1, "python", ["Python"]), (1, "sql", ["SQL"]), (None, "python and sql", ["Python", "SQL"]), (2, None, []), (2, "", [])], key=str)
    for found in (R.with_terms(df, "text", terms), R.with_terms_by_join(df, "text", frame)):
        assert sorted(((r.id, r.text, r.technical_tools) for r in found.collect()), key=str) == want
        assert found.columns == [*df.columns, "technical_tools", "technical_concepts", "certifications"]


def test_terms_meet_in_salted_shares(spark, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_TERMS", 0)
    frame = R.terms_frame(spark, TERMS)
    expected = {k: tuple(sorted(x) for x in v[1:]) for k, v in TEXTS.items()}
    assert _found(R.with_terms_by_join(_texts(spark), "text", frame)) == expected


def test_text_after_an_answer_fails_it(spark):
    rows = [('{"technical_tools":["a"]}',), ('{"technical_tools":["a"]} trailing',), ('{"technical_tools":["x"]}],[1',)]
    got = R.parse_responses(spark.createDataFrame(rows, "response string")).collect()
    assert [r.extraction_status for r in got] == ["validated", "failed", "failed"]


def test_placeholders_are_the_callers_choice(spark):
    df = spark.createDataFrame([('{"technical_tools":["a","tbd","N/A"]}',)], "response string")
    assert R.parse_responses(df, dropped=["tbd"]).first().technical_tools == ["a", "N/A"]


def test_years(spark):
    cases = [
        ("2.5 years of SQL", 2, None),
        ("1.5+ years", 1, None),
        ("3,5 years", 3, None),
        ("between 3 and 5 years", 3, 5),
        ("entre 2 et 4 années", 2, 4),
        ("5 or more years", 5, None),
        ("10-plus years", 10, None),
        ("3 à 5 ans", 3, 5),
        ("1,500 years, 100 years", None, None),
        ("2-4 years", 2, 4),
        ("3+ years", 3, None),
        ("N/A", None, None),
        ("5 to 7 yrs", 5, 7),
        ("at least 1 year", 1, None),
        ("3 years of SQL\n4 to 6 years overall\n2 – 9 years", 2, 9),
        ("since 2015 years", None, None),
        (None, None, None),
    ]
    df = spark.createDataFrame(cases, "t string, low int, high int")
    got = R.with_years(df, "t").filter("not (min_years <=> low and max_years <=> high)").collect()
    assert got == []


def test_clean_lists(spark):
    values = ["Python", "N/A", None, " SQL ", "NONE", " null\t", "", "unknown", "Python"]
    df = spark.createDataFrame([(values,), (None,)], "v array<string>")
    kept = [r[0] for r in df.select(Q.clean_list(F.col("v"))).collect()]
    assert kept == [["Python", " SQL ", "unknown", "Python"], []]
    strict = set(DROPPED_LIST_VALUES) | set(PLACEHOLDER_VALUES)
    assert df.select(Q.clean_list(F.col("v"), strict)).first()[0] == ["Python", " SQL ", "Python"]


RESPONSES = [
    ('{"technical_tools":["Python","N/A",null," SQL "],"min_years":3}', "validated", ["Python", " SQL "], 3),
    ('{"technical_tools":["Spark"],"min_years":"2"}', "validated", ["Spark"], 2),
    ('{"min_years":5.0}', "validated", [], 5),
    ("{}", "validated", [], None),
    ('{"technical_tools":null,"min_years":null}', "validated", [], None),
    ('{"technical_tools":"Python"}', "failed", [], None),
    ('{"technical_tools":["Python",7]}', "failed", [], None),
    ('{"technical_tools":["Python"],"min_years":2.5}', "failed", [], None),
    ('{"technical_tools":["Python"],"min_years":"many"}', "failed", [], None),
    ('["Python"]', "failed", [], None),
    ("not json", "failed", [], None),
    ("  ", "skipped", [], None),
    (None, "skipped", [], None),
]


def test_responses(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(RESPONSES)], "id int, response string")
    rows = R.parse_responses(df).orderBy("id").collect()
    assert [(r.extraction_status, r.technical_tools, r.min_years) for r in rows] == [r[1:] for r in RESPONSES]
    assert all((r.error is None) == (r.extraction_status == "validated") for r in rows)


def test_items(spark):
    df = spark.createDataFrame(
        [("A", "1", ["Python ", None], [], None), ("A", "2", None, ["ETL"], ["Cert"])],
        "source string, source_job_id string, technical_tools array<string>, technical_concepts array<string>, certifications array<string>",
    )
    rows = {(r.source_job_id, r.item_type, r.item_value, r.item_value_norm) for r in requirement_items(df).collect()}
    assert rows == {
        ("1", "technical_tool", "Python ", "python"),
        ("1", "technical_tool", None, None),
        ("2", "technical_concept", "ETL", "etl"),
        ("2", "certification", "Cert", "cert"),
    }


def test_items_read_the_table_once_and_keep_every_element(frames, spark, tmp_path):
    path = str(tmp_path / "r")
    frames.requirements.write.parquet(path)
    table = spark.read.parquet(path)
    items = requirement_items(table)
    sizes = F.sum(sum(F.size(c) for c in ("technical_tools", "technical_concepts", "certifications")))
    assert items.count() == table.agg(sizes).first()[0]
    assert items._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_model_plug_in(spark):
    described = spark.createDataFrame(
        [("A", "1", "Data Engineer", "data engineer", "<p>Skills</p><ul><li>Python</li></ul>"), ("A", "2", "Cook", "x", "")],
        "source string, source_job_id string, job_title string, role_title string, html_description string",
    )

    def answer(texts):
        return texts.map(lambda t: json.dumps({"technical_tools": t.split(), "min_years": 6}))

    rows = {r.source_job_id: r for r in R.build_requirements_from_model(described, answer).collect()}
    assert rows["1"].technical_tools == ["Python"] and rows["1"].seniority == "senior"
    assert rows["2"].extraction_status == "skipped" and rows["2"].error == "No requirement section extracted"


def test_backlog_keeps_failed_and_skipped_jobs(spark):
    jobs = spark.createDataFrame([("A", str(i)) for i in range(4)], "source string, source_job_id string")
    done = spark.createDataFrame(
        [("A", "0", "validated"), ("A", "1", "failed"), ("A", "2", "skipped")],
        "source string, source_job_id string, extraction_status string",
    )
    assert sorted(r.source_job_id for r in R.extraction_backlog(jobs, done).collect()) == ["1", "2", "3"]


def test_inline_terms_list_no_phrases_and_equal_the_join(spark):
    """Every term is looked for in the line of tokens: runs of words are not built; null, repeats and line ends as before."""
    from jobtide.operators.requirements import Term, terms_frame, with_terms, with_terms_by_join

    terms = [
        Term("c", "technical_tool", "C"), Term("c++", "technical_tool", "C++"), Term("sql", "technical_tool", "SQL"),
        Term("Machine  Learning", "technical_concept", "ML"), Term("machine learning", "technical_concept", "Learning"),
        Term("a a", "technical_concept", "AA"), Term(".net", "certification", ".NET"),
    ]
    texts = [None, "", "c++", "C, C++", "machine\nlearning", "Machine-learning sql", "machine learnings", "a a a", "aa a", "x.net .NET", "sqlc"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    found = with_terms(df, "text", terms)
    by_join = with_terms_by_join(df, "text", terms_frame(spark, terms))
    assert sorted(found.collect()) == sorted(by_join.collect(), key=lambda r: r.n)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in plan and "array_intersect(" not in plan
