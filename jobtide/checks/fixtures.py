"""Job-posting tables derived from the given tables.

Each view text is one SQL statement that Spark and DuckDB read alike, so both
sides of a check start from the same rows.  Sizes follow ``orders`` and
``pages``; nothing is capped.
"""

from __future__ import annotations

from datetime import datetime

from jobtide.operators.requirements import Term
from jobtide.operators.roles import Role

AS_OF = datetime(2001, 9, 1)
# Postings created before this time were landed by an earlier run.
LANDED_UNTIL = datetime(1998, 1, 1)
SOURCES = ("BoardA", "BoardB")

PREFIXES = "|Senior |Sr. |Jr. |Staff |New Grad |Junior |Lead "
TITLES = (
    "Data Engineer|Développeur(euse) logiciel|ML Engineer, NLP|Analyste de données|Cook"
    "|Engineer of Data Platforms|Python Developer|Generative AI Consultant|Databricks Lead"
    "|International Sales|Scientifique de données|Software Development Engineer"
    "|Ingénieur de données|Développeur·se Full Stack|SWE Backend|AI/ML Researcher|Prompt Engineer"
    "|C# .NET Developer|Node.js Developers|Architecte données|Stage en IA appliquée"
    "|Computer Vision Lead|Artificial Intelligence Specialist|Machine Learning Engineers (Remote)"
    "|Head of Data|Engineering Manager, Data|Co-Founder Engineer|Python Dev"
)
N_TITLES = TITLES.count("|") + 1

POSTINGS = f"""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'BoardB' ELSE 'BoardA' END AS source,
       CAST(CASE WHEN o_orderkey % 10 = 9 THEN o_orderkey - 3
                 WHEN o_orderkey % 10 = 8 THEN o_orderkey - 1
                 ELSE o_orderkey END AS VARCHAR(20)) AS source_job_id,
       o_orderdate AS created_at,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate + INTERVAL 3 DAY END AS fetched_at,
       o_orderkey AS seq,
       o_orderpriority <> '5-LOW' AS scraped,
       split_part('data engineer|software engineer|ml engineer|data analyst|software engineer|data engineer', '|',
                  CAST(o_custkey % 6 + 1 AS INT)) AS search_term,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            ELSE 'https://jobs.example.com/' || CAST(o_orderkey AS VARCHAR(20)) END AS redirect_url,
       '{{"id":"' || CAST(o_orderkey AS VARCHAR(20))
       || '","created":"' || replace(CAST(o_orderdate AS VARCHAR(30)), ' ', 'T') || 'Z"'
       || CASE WHEN o_orderkey % 13 = 0 THEN ''
               ELSE ',"redirect_url":"https://jobs.example.com/' || CAST(o_orderkey AS VARCHAR(20)) || '"' END
       || ',"title":"' || split_part('{PREFIXES}', '|', CAST(o_custkey % 8 + 1 AS INT))
       || split_part('{TITLES}', '|', CAST(o_orderkey % {N_TITLES} + 1 AS INT))
       || CASE o_custkey % 5 WHEN 0 THEN ', Senior' WHEN 1 THEN ' (H/F)'
               WHEN 2 THEN ' - Team ' || CAST(o_custkey AS VARCHAR(20)) ELSE '' END
       || '","company":{{"display_name":'
       || CASE WHEN o_custkey % 17 = 0 THEN 'null'
               ELSE '"C' || CAST(o_custkey AS VARCHAR(20)) || '"' END
       || '}},"location":{{"display_name":"'
       || split_part('Montreal|Toronto|Remote', '|', CAST(o_custkey % 3 + 1 AS INT)) || '"}}'
       || CASE WHEN o_orderkey % 6 = 0 THEN ''
               ELSE ',"salary_min":' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR(20))
                 || ',"salary_max":' || CAST(CAST(floor(o_totalprice) AS BIGINT) + 10000 AS VARCHAR(20)) END
       || '}}' AS raw_json
FROM orders
"""

POSTING_KEYS = "SELECT DISTINCT source, source_job_id, CAST(source_job_id AS BIGINT) AS job_no FROM postings"

# Postings of low priority have no description yet.
SCRAPED_KEYS = POSTING_KEYS + " WHERE scraped"

_K = "job_no"
DESCRIPTIONS = f"""
SELECT source, source_job_id,
       'https://jobs.example.com/' || source_job_id AS redirect_url,
       CASE {_K} % 15
         WHEN 0 THEN '<div>Plain text only</div>'
         WHEN 1 THEN '<div>Requirements<br>- Python and SQL<br>similar tools<br>2.5 years of SQL<br>&bull; 4 to 6 years overall</div>'
         WHEN 2 THEN '<p>About us: we ship data.</p><p><strong>Qualifications</strong></p><ul><li>3+ years of <b>Python</b></li><li>AWS Certified Developer</li></ul><p>Benefits</p><ul><li>Dental</li></ul>'
         WHEN 3 THEN '<h3>What you&#8217;ll bring</h3><div><ul> <li>SQL &amp; Spark</li> <li>2-4 years &lt; 5</li> </ul></div>'
         WHEN 4 THEN 'Intro text <b>Benefits</b><ul><li>Lunch</li></ul><b>Nice to have</b> <ol><li>dbt</li><li><p>ETL</p></li></ol>'
         WHEN 5 THEN ''
         WHEN 6 THEN '<p>We use Spark and dbt daily.</p><p>Join our team in Montr&eacute;al</p>'
         WHEN 7 THEN '<!-- Requirements --><div>Who we hire<ul><li>Builders<ul><li>SQL</li></ul></li><li>Makers</li></ul>tail<ul><li>x</li></ul></div>'
         WHEN 8 THEN '<p>• Experience with Python<br>on AWS</p><p>1) machine learning<br>2) data modeling</p><script>var x="<ul><li>no</li></ul>";</script>'
         WHEN 9 THEN '<h3>What you&apos;ll bring</h3><ul><li>SQL</li></ul> <ul><li>Spark</li></ul> <ul><li>dbt</li></ul><p>What we&#146;re looking for</p><ul><li>Scala</li></ul>'
         WHEN 10 THEN '<h2>Perks</h2><ul><li>Lunch</li></ul><h2>What you&#00008217;ll bring</h2><ul><li>C++&nbsp and SQL</li></ul>'
         ELSE '<div><h3>' || split_part('Requirements|About us|What you will bring|Benefits', '|', CAST(floor({_K} / 13) % 4 + 1 AS INT))
           || '</h3><ul><li>' || split_part('Airflow|C++|.NET|Tableau|PyTorch|Node.js|Scala', '|', CAST(floor({_K} % 28 / 4) + 1 AS INT))
           || '</li><li>' || split_part('3+ years|2-4 years|5 years|N/A', '|', CAST({_K} % 4 + 1 AS INT))
           || ' of experience</li><li>'
           || split_part('machine learning|data modeling|AWS Certified Developer', '|', CAST({_K} % 3 + 1 AS INT))
           || '</li></ul></div>'
       END AS html_description
FROM scraped_keys
"""

RESPONSES = """
SELECT source, source_job_id,
       CASE job_no % 9
         WHEN 0 THEN '{"technical_tools":["Python","N/A",null," SQL "],"technical_concepts":["ETL"],"certifications":["none"],"min_years":3,"max_years":null}'
         WHEN 1 THEN '{"technical_tools":["Spark"],"min_years":"2"}'
         WHEN 2 THEN '{"technical_tools":"Python"}'
         WHEN 3 THEN 'not json'
         WHEN 4 THEN NULL
         WHEN 5 THEN '{"technical_tools":null,"technical_concepts":[],"certifications":["AWS Certified Developer"],"min_years":5.0,"max_years":7}'
         WHEN 6 THEN '{"technical_tools":["Python",7]}'
         WHEN 7 THEN '["Python"]'
         ELSE '{"min_years":2.5,"max_years":"many"}'
       END AS response
FROM posting_keys
"""

# Pages as postings show them: the text sits in one of the known containers, in
# a nested one, or in none.
JOB_PAGES = """
SELECT page_id, url,
       CASE page_id % 5
         WHEN 0 THEN replace(replace(html, '<article>', '<article title="a > b" id=jobDescription>'),
                             '<!-- ad', '<!-- <article id="jobDescription">no</article> x')
         WHEN 1 THEN replace(replace(html, '<article>', '<div class="card job-description"><div>'), '</article>', '</div></div>')
         WHEN 2 THEN replace(replace(html, '<article>', '<section class=''adp-body''>'), '</article>', '</section>')
         WHEN 3 THEN replace(replace(html, '<article>', '<div data-testid="viewJobBodyContainer">'), '</article>', '</div>')
         ELSE html END AS html
FROM pages
"""

# A section text per document: its own lines, some of them made list-like, and
# header lines between them.
LINES = """
SELECT doc_id, CASE doc_id % 6
                 WHEN 0 THEN '• ' || text
                 WHEN 1 THEN split_part('2.5 years |between 3 and 5 years |5 or more years |10-plus years |3 à 5 ans |1,5+ yrs ', '|',
                                        CAST(floor(doc_id / 6) % 6 + 1 AS INT)) || text
                 WHEN 2 THEN 'What you will bring ' || text
                 WHEN 3 THEN text || ' 3 to 5 years, NLP and machine   learning &amp; more’s'
                 WHEN 4 THEN '.NET ' || text || ' (EXPERIENCE)'
                 ELSE text END AS line
FROM documents
"""

ROLES = (
    Role("data engineer", ("data engineer", "etl developer"), ("data engineer",)),
    Role("data scientist", ("data scientist",), ("data scientist",)),
    Role("data analyst", ("data analyst", "analyste data"), ("data analyst", "bi analyst")),
    Role("ml engineer", ("ml engineer", "machine learning engineer"), ("ml engineer",)),
    Role("ai developer", ("ai developer", "ai engineer"), ("ai developer",)),
    Role("software engineer", ("software engineer", "software developer"), ("software engineer", "software developer")),
)

TERMS = (
    Term("python", "technical_tool", "Python"),
    Term("sql", "technical_tool", "SQL"),
    Term("spark", "technical_tool", "Spark"),
    Term("dbt", "technical_tool", "dbt"),
    Term("aws", "technical_tool", "AWS"),
    Term("airflow", "technical_tool", "Airflow"),
    Term("c++", "technical_tool", "C++"),
    Term(".net", "technical_tool", ".NET"),
    Term("tableau", "technical_tool", "Tableau"),
    Term("pytorch", "technical_tool", "PyTorch"),
    Term("node.js", "technical_tool", "Node.js"),
    Term("scala", "technical_tool", "Scala"),
    Term("machine learning", "technical_concept", "machine learning"),
    Term("data modeling", "technical_concept", "data modeling"),
    Term("etl", "technical_concept", "ETL"),
    Term("aws certified developer", "certification", "AWS Certified Developer"),
)
