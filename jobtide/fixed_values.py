"""Values that must be exactly these for the results to be right.

Everything here is data: word lists, patterns, formats and limits.  Patterns
use only syntax shared by Java regular expressions and RE2, so the same text
can be checked in a second SQL engine.
"""

# --- fixed values: landing ------------------------------------------------
# Words that disqualify a posting when they occur in its title.
EXCLUDED_TERMS = (
    "director",
    "head",
    "president",
    "vice",
    "vp",
    "chief",
    "founder",
    "co-founder",
    "manager",
    "gestionnaire",
    "directeur",
)
RESULTS_PER_PAGE = 50
MAX_PAGES = 10
MAX_DAYS_OLD = 30

# Containers that hold the description of a posting page.
DESCRIPTION_SELECTORS = (
    "section.adp-body",
    "div.job-description",
    "div.description",
    "article#jobDescription",
    "div[data-testid='viewJobBodyContainer']",
    "div.sc-666b1ca0-11",
)

# Relations that may be counted.
COUNTABLE_TABLES = (
    "jobs_raw",
    "descriptions_raw",
    "jobs",
    "job_requirements",
    "job_requirement_items",
)

# --- fixed values: title rewrite rules, (pattern, replacement), in order ---
BILINGUAL_RULES = (
    (r"[éè]", "e"),
    (r" +ia +", " ai "),
    (r"(·|\.)(euse|se|e)|\((\-?euse|se|e)\)", ""),
    (r"(ingenieur|ingenierie) logiciel", "software engineer"),
    (r"(ingenieur|ingenierie|architecte)( de)? donnees", "data engineer"),
    (r"(developpeur|developpement)( de)? logiciel", "software developer"),
    (r"science des? donnees|scientifique des? donnees", "data scientist"),
    (r"(des? )?donnees", "data"),
    (r"developpeur|(^|\s+)dev(\s+|$)", "developer"),
    (r"ingenieur", "engineer"),
    (r"(stagaire|stage)( +en)?", "internship"),
)

SENIORITY_WORDS = (
    r"\b(senior|sr\.?|staff|intermediate|associate|junior|jr\.?|internship|intern"
    r"|new grad(uate)?|rotational program)( |,|\)|$)?\b"
)
LEADING_NON_LETTERS = r"^[^a-zA-Z]+"

COMMON_TERM_RULES = (
    (r"prompt engineer", "ai developer"),
    (r"software development|software dev ", "software developer"),
    (r"swe ", "software engineer "),
    (r"ai/ml|artificial intelligence", "ai"),
    (
        r"(python|c#(/\.net)?|net|javascript|typescript|(c/)?c\+\+|react|node\.?js?|java|c(-| )sharp) developer",
        "software developer",
    ),
    (r"engineering|engineers", "engineer"),
    (r"development|developers", "developer"),
)

# Keyword fallback, (role, keywords), tried in order.  A keyword is bounded on
# the left by start, space, "(" or "/" and on the right by space or end.
KEYWORD_ROLES = (
    ("ai developer", r"ai|agentic|gen(erative|\s+)ai"),
    ("ml engineer", r"ml|machine learning|nlp|computer vision|deep learning"),
    ("data engineer", r"databricks|snowflake|data architect|etl"),
)
KEYWORD_LEFT = r"(^|\s+|\(|/)"
KEYWORD_RIGHT = r"(\s+|$)"

EXACT_MATCH = "exact_match"
FLEXIBLE_MATCH = "flexible_match"
KEYWORD_MATCH = "keyword_match"
NO_MATCH = "_FAILED_"

# Seniority words looked up anywhere in a lower-cased title, in order.
SENIORITY_TITLE_WORDS = (
    ("junior", ("intern", "internship", "student", "co-op", "new grad")),
    ("junior", ("junior", "jr.", "associate")),
    ("senior", ("senior", "sr.", "lead", "staff", "principal")),
)
JUNIOR_UP_TO_YEARS = 2
SENIOR_FROM_YEARS = 5

# --- fixed values: requirement sections ------------------------------------
# Whole words, anywhere in the text, in any case.
SKILL_HEADERS = (
    r"requirements?",
    r"qualifications?",
    r"must[- ]?haves?",
    r"nice[- ]to[- ]have",
    r"technical (skills|expertise)",
    r"skills?",
    r"experience",
    r"what you('ll| will) bring",
    r"you bring",
    r"what we are looking for",
    r"what we're looking for",
    r"what we looking for",
    r"what you need to have",
    r"what do we expect",
    r"ideal candidate",
    r"what you may have",
    r"how you will succeed",
    r"your responsibilities",
    r"what you've done",
    r"who you are",
    r"prerequisites",
)
BULLET_PREFIX = r"^\s*(?:•|·|⁃|∙|‣|◦|\*|-|▪|■|\.|\d+[.)])\s*"
# Left and right single quotation marks, low-9 and reversed-9 marks, acute accent.
APOSTROPHES = "‘’‚‛´"

# --- fixed values: structured requirements ---------------------------------
TECHNICAL_TOOL = "technical_tool"
TECHNICAL_CONCEPT = "technical_concept"
CERTIFICATION = "certification"
DROPPED_LIST_VALUES = ("none", "null", "n/a", "")
PLACEHOLDER_VALUES = (
    "none",
    "n/a",
    "na",
    "not specified",
    "not mentioned",
    "not provided",
    "unknown",
    "null",
)
VALIDATED = "validated"
SKIPPED = "skipped"
FAILED = "failed"
