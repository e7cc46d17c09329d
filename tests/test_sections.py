import pytest
from pyspark.sql import functions as F

from jobtide.functions import sections as S
from jobtide.functions import text as T
from jobtide.operators import pages as P

NBSP = " "

SECTIONS = [
    # plain text, no items
    ("<div>Plain text only</div>", "Plain text only"),
    ("", ""),
    (None, ""),
    # header line inside the block, bullets, continuation, numbers
    (
        "<div>Requirements<br>- Python and SQL<br>similar tools<br>2.5 years of SQL<br>&bull; 4 to 6 years</div>",
        "Python and SQL similar tools\n5 years of SQL\n4 to 6 years",
    ),
    # a line before the header does not continue anything
    ("<div>- a<br>b<br>Skills<br>c<br>- d<br>e</div>", "a c\nd e"),
    # header above the list, other list ignored
    (
        "<p><strong>Qualifications</strong></p><ul><li>3+ <b>years</b></li></ul><p>Benefits</p><ul><li>Dental</li></ul>",
        "3+ years",
    ),
    # header outside the division that holds the list; curly apostrophe
    ("<h3>What you&#8217;ll bring</h3><div><ul> <li>SQL &amp; Spark</li> <li>x &lt; 5</li></ul></div>", "SQL & Spark\nx < 5"),
    # bold text right above the list counts, text before it does not
    ("Experience <b>Benefits</b><ul><li>Lunch</li></ul><b>Must-haves</b><ol><li>dbt</li></ol>", "dbt"),
    # two lists below one header
    ("<p>Skills</p><ul><li>a</li></ul><ul><li>b</li></ul>", "a\nb"),
    # nested list, list after a tail text; no header: all items
    ("<div>Who we hire<ul><li>A<ul><li>B</li></ul></li><li>C</li></ul>tail<ul><li>D</li></ul></div>", "A\nB\nC\nD"),
    # the first line of a list flags the list
    ("<p>About</p><ul><li>Experience with X</li><li>Y</li></ul>", "Experience with X\nY"),
    ("<p>About</p><ul>\n<li>Experience with X</li></ul><p>Skills</p><ul><li>Z</li></ul>", "Z"),
    # script, style and comments are no text
    ("<!-- Requirements --><p>Hi</p><script>var x='<ul><li>no</li></ul>';</script><ul><li>yes</li></ul>", "yes"),
    # spaces
    (f"<p>Skills{NBSP}needed</p><ul><li>{NBSP} a&nbsp; b </li><li> </li></ul>", "a b"),
    # unclosed entries
    ("<p>Skills</p><ul><li>a<li>b</ul>", "a\nb"),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(i, h, s) for i, (h, s) in enumerate(SECTIONS)], "id int, html string, expected string")


def test_requirement_sections(documents):
    got = S.with_requirement_section(documents, "html").filter("section <> expected").collect()
    assert got == []


def test_sections_do_not_shuffle(documents):
    plan = S.with_requirement_section(documents, "html")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_result_does_not_depend_on_partitioning(frames):
    one = S.with_requirement_section(frames.descriptions.repartition(1), "html_description")
    many = S.with_requirement_section(frames.descriptions.repartition(64), "html_description")
    assert one.exceptAll(many).isEmpty()


def test_huge_page_is_processed_whole(spark):
    """Thousands of entries in one page: every one is kept, long blank runs are harmless."""
    html = "<p>Skills</p><ul>" + "".join(f"<li>item {i}</li>" for i in range(20000)) + "</ul>" + " \n" * 50000
    html += "".join(f"<p>Skills {i}</p><p>- more {i}</p>" for i in range(3000))
    row = S.with_requirement_section(spark.createDataFrame([(html,)], "html string"), "html").first()
    lines = row.section.split("\n")
    assert lines[:2] == ["item 0", "item 1"] and len(lines) == 23000 and lines[-1] == "more 2999"


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("a&nbsp;b", "a b"),
        ("&amp;lt;b&amp;gt;", "&lt;b&gt;"),
        ("&#8226; &#x2022; &eacute;&unknown;", "• • é&unknown;"),
        ("&#128512;", "\U0001f600"),
        ("1 &lt; 2", "1 < 2"),
        ("no reference", "no reference"),
    ],
)
def test_entities(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "h string")
    assert df.select(T.reveal(T.decode_entities(F.col("h")))).first()[0] == expected


def test_text_nodes_and_plain_text(spark):
    html = "<html><head><title>T</title><style>p{}</style></head><body> a <b>b</b><!-- c --><p> d\n</p><br/>e</body>"
    df = spark.createDataFrame([(html,), (None,)], "h string")
    rows = df.select(T.plain_text(F.col("h")), T.plain_text(F.col("h"), "|")).collect()
    assert [tuple(r) for r in rows] == [("Tabde", "T|a|b|d|e"), ("", "")]


def test_normalize_text(spark):
    cases = [
        (f" a{NBSP}’s\t&amp; b\n", "a 's & b"),
        (None, ""),
        ("‘’‚‛´", "'''''"),
        ("x 　y", "x y"),
        ("plain text", "plain text"),
    ]
    df = spark.createDataFrame(cases, "t string, expected string")
    assert df.filter(T.normalize_text(F.col("t")) != F.col("expected")).collect() == []


@pytest.mark.parametrize(
    "line, expected",
    [(".NET developer", "NET developer"), ("2.5 years", "5 years"), ("• a", "a"), ("- - a", "- a"), ("10) x", "x"), ("a - b", "a - b")],
)
def test_strip_bullets(spark, line, expected):
    assert spark.createDataFrame([(line,)], "l string").select(S.strip_bullet(F.col("l"))).first()[0] == expected


def test_skill_headers(spark):
    yes = [
        "Required Qualifications", "MUST-HAVES", "must have", "Nice-to-have", "Technical Expertise", "Core engineering skills",
        "Experience & qualifications", "Here's what you'll bring", "What you will bring", "You bring", "What we are looking for",
        "What we're looking for", "What we looking for", "What you need to have", "What do we expect", "You're our ideal candidate",
        "What you may have", "How you will succeed", "Your responsibilities", "What you've done", "Who you are", "Prerequisites",
    ]
    no = ["Benefits", "About us", "experienced", "reskilling", "who we are", ""]
    df = spark.createDataFrame([(t, True) for t in yes] + [(t, False) for t in no], "t string, expected boolean")
    assert df.filter(S.is_skill_header(F.col("t")) != F.col("expected")).collect() == []


CONTAINERS = [
    ("<body><section class='x adp-body'> <p>a</p> </section></body>", "<p>a</p>"),
    ('<div class="job-description"><div>a</div><div>b<div>c</div></div></div><div>d</div>', "<div>a</div><div>b<div>c</div></div>"),
    ('<div class="not-job-description">x</div><article id="jobDescription">y</article>', "y"),
    ("<div data-testid='viewJobBodyContainer'>z</div>", "z"),
    ('<div class="description">never <div>closed', "never <div>closed"),
    ('<article id="jobDescription">first</article><div class="description">second</div>', "first"),
    ("<title>\U0001f600 \U0001f680</title><div class='description'>after \U0001f600</div>", "after \U0001f600"),
    ('<div class="description"></div>', ""),
    ("<div>none</div>", None),
    (None, None),
]


def test_main_container(spark):
    df = spark.createDataFrame(CONTAINERS, "html string, expected string")
    assert P.with_main_container(df, "html").filter("not (container <=> expected)").collect() == []


def test_unsupported_selector():
    with pytest.raises(ValueError):
        P.selector_pattern("div > p")


def test_list_items_count_every_entry(frames):
    df = frames.given("pages")
    entries = df.agg(F.sum(F.regexp_count("html", F.lit(r"<li\b")))).first()[0]
    assert P.list_items(df, ["page_id"], "html").count() == entries


def test_character_references(spark):
    from html import unescape

    from jobtide.functions.text import decode_entities, reveal

    text = (
        "a&apos;b &check; &NewLine;x &nbspy &eacute &eacutex &#146; &#00008217; &amp;lt; &lt;b&gt; &bogus; &notit;"
        " &#0; &#x110000; &#xD800; AT&T &#x2019 &#9999999999999; a & b &"
    )
    got = spark.createDataFrame([(text,)], "t string").select(reveal(decode_entities(F.col("t")))).first()[0]
    assert got == unescape(text)


SPACED = "\u2003".join("<ul><li>%s</li></ul>" % x for x in ("SQL", "Spark", "dbt"))


@pytest.mark.parametrize(
    "html, expected",
    [
        (f"<p>Requirements</p>{SPACED}", "SQL\nSpark\ndbt"),
        ("<h3>what you&apos;ll bring</h3><ul><li>a</li></ul><h3>Perks</h3><ul><li>b</li></ul>", "a"),
        ("<h3>what you&#146;ll bring</h3><ul><li>a</li></ul><h3>Perks</h3><ul><li>b</li></ul>", "a"),
    ],
)
def test_headers_above_several_lists(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert S.with_requirement_section(df, "html").first().section == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<!-- <div class="description">no</div> --><div class="description">yes</div>', "yes"),
        ("<script>var x='<div class=\"description\">no</div>';</script><div class=\"description\">yes</div>", "yes"),
        ('<div class="description">a<!-- </div> -->b</div>c', "a<!-- </div> -->b"),
        ("<div class=description>yes</div>", "yes"),
        ('<div title="a > b" class="x description">yes</div>', "yes"),
        ('<div class="description">a\x1fb<div>c</div></div>', "ab<div>c</div>"),
        ('<div class="descriptions">no</div>', None),
    ],
)
def test_containers(spark, html, expected):
    from jobtide.operators.pages import with_main_container

    df = spark.createDataFrame([(html,)], "html string")
    assert with_main_container(df, "html", selectors=["div.description"]).first().container == expected


@pytest.mark.parametrize(
    "tag",
    ["<div" + " a" * 20_000 + ">", "<div " + "x='1' " * 20_000 + ">", "<div class='" + "y " * 20_000 + "'>", "<" * 20_000, "<div " + '"' * 20_001],
)
def test_a_tag_of_any_length_costs_no_stack(spark, tag):
    from jobtide.functions.text import plain_text
    from jobtide.operators import pages

    df = spark.createDataFrame([(f"{tag}<div class='x description y'>found <b>it</b></div>",)], "html string")
    found = "found <b>it</b>" if tag.endswith(">") or tag.startswith("<<") else None
    got = pages.with_main_container(df, "html").first().container
    assert got == found or found is None
    assert df.select(plain_text(F.col("html")).alias("t")).first().t is not None
    for rows in (pages.list_items(df, [], "html"), pages.section_headers(df, [], "html"), pages.text_reduction(df, "html")):
        rows.collect()


def test_attributes_in_other_values_are_none(spark):
    rows = [
        ("<div title=' class=\"description\"'>no</div><div class=description>yes</div>", "yes"),
        ("<div class='a' class='description'>no</div>", None),
        ("<div class='description-long'>no</div><div class='long description'>yes</div>", "yes"),
        ("<div class='descriptions'>no</div>", None),
        ("<DIV\nCLASS = \"description\" id=x>yes<DIV>in</DIV></DIV>no", "yes<DIV>in</div>"),
        ("<divider class='description'>no</divider>", None),
    ]
    df = spark.createDataFrame(rows, "html string, expected string")
    from jobtide.operators.pages import with_main_container

    got = with_main_container(df, "html", selectors=["div.description"])
    assert got.filter("NOT (container <=> expected)").collect() == []
