"""Queries on name matching. Both sides of every match are derived from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from almoner.functions import text as T
from almoner.operators import matching as M
from almoner.plans.registry import query, rounded

_COLUMN = {
    "STANDARD": "gift amount",
    "ECONOMY": "phone number",
    "MEDIUM": "emailAddress",
    "PROMO": "volunteer_service",
    "LARGE": "event date",
}
_ASK = ((8, "donation total"), (16, "tel num"), (24, "electronic_mail"), (32, "activityType"), (40, "Company Name"))

NAMES_SQL = (
    "WITH names AS (SELECT DISTINCT CASE p_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _COLUMN.items())
    + " ELSE 'company name' END || ' ' || split_part(p_name, ' ', 2) AS n FROM part), asked AS (SELECT DISTINCT CASE "
    + " ".join(f"WHEN p_size < {k} THEN '{v}'" for k, v in _ASK)
    + " ELSE 'first_name' END || CASE WHEN p_type IN ('LARGE', 'SMALL') THEN '' ELSE ' ' || split_part(p_name, ' ', 1) END AS q FROM part)"
)


# The tables are written out again on this side, so that a wrong entry in the library shows.
EXPAND_SQL = """(SELECT MAP(list(word), list(others)) FROM (
  SELECT word, list_sort(list(DISTINCT other)) AS others FROM (
    SELECT short AS word, full_form AS other FROM (VALUES
    ('addr', 'address'), ('st', 'street'), ('ave', 'avenue'), ('rd', 'road'), ('dr', 'drive'), ('ln', 'lane'),
    ('blvd', 'boulevard'), ('ct', 'court'), ('apt', 'apartment'), ('ste', 'suite'), ('bldg', 'building'),
    ('ph', 'phone'), ('tel', 'telephone'), ('mob', 'mobile'), ('fax', 'facsimile'),
    ('email', 'electronic mail'), ('dob', 'date of birth'), ('ssn', 'social security number'),
    ('id', 'identifier'), ('num', 'number'), ('qty', 'quantity'), ('amt', 'amount'), ('org', 'organization'),
    ('corp', 'corporation'), ('co', 'company'), ('dept', 'department'), ('mgr', 'manager'),
    ('rep', 'representative'), ('info', 'information'), ('desc', 'description'), ('temp', 'temporary'),
    ('pref', 'preference'), ('req', 'required'), ('opt', 'optional'), ('vol', 'volunteer'), ('mem', 'member'),
    ('sub', 'subscriber'), ('reg', 'registration'), ('cert', 'certificate'), ('qual', 'qualification')
    ) AS a(short, full_form)
    UNION ALL SELECT head, unnest(words) FROM synonyms
    UNION ALL SELECT unnest(words), head FROM synonyms
    UNION ALL SELECT w.word, o.other FROM (SELECT head, unnest(words) AS word FROM synonyms) w
      JOIN (SELECT head, unnest(words) AS other FROM synonyms) o ON o.head = w.head)
  GROUP BY word))"""
SYNONYMS_SQL = """synonyms(head, words) AS (VALUES
    ('address', ['location', 'residence', 'home', 'place', 'site']),
    ('phone', ['telephone', 'mobile', 'cell', 'contact']),
    ('email', ['mail', 'electronic_mail', 'contact']),
    ('name', ['title', 'label', 'designation']),
    ('first_name', ['given_name', 'forename']),
    ('last_name', ['surname', 'family_name']),
    ('company', ['organization', 'business', 'employer', 'corporation']),
    ('donation', ['gift', 'contribution', 'pledge']),
    ('volunteer', ['service', 'help', 'assist']),
    ('member', ['subscriber', 'participant', 'supporter']),
    ('event', ['activity', 'program', 'meeting']),
    ('date', ['time', 'when', 'timestamp']),
    ('amount', ['value', 'total', 'sum', 'cost', 'price']),
    ('type', ['kind', 'category', 'classification']),
    ('status', ['state', 'condition', 'situation']))"""
STOP_SQL = "('a', 'an', 'the', 'of', 'for', 'in', 'on', 'at', 'to', 'is', 'are', 'and', 'or')"


def _words(c):
    return f"list_filter(regexp_split_to_array(lower({c}), '[_\\-\\s]+'), lambda w: w <> '')"


def _meaning(c):
    spaced = f"regexp_replace({c}, '([a-z])([A-Z])', '\\1 \\2', 'g')"
    words = f"regexp_split_to_array(lower(regexp_replace({spaced}, '[_\\-\\.]+', ' ', 'g')), '\\s+')"
    return f"list_filter({words}, lambda w: length(w) > 2 AND w NOT IN {STOP_SQL})"


def _expanded(c):
    return f"list_distinct(list_concat({c}, flatten(list_transform({c}, lambda w: coalesce(x.m[w], [])))))"


def fuzzy_sql(asked="asked", names="names", name="fz"):
    return f""", {name}_p AS (SELECT q, n, lower(q) AS a, lower(n) AS b, {_words('q')} AS wa, {_words('n')} AS wb FROM {asked}, {names}),
{name}_w AS (SELECT *, CASE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0.0::DOUBLE ELSE list_sum(list_transform(wa, lambda s: coalesce(list_filter(list_transform(wb,
    lambda t: CASE WHEN s = t THEN 1.0::DOUBLE WHEN starts_with(s, t) OR starts_with(t, s) THEN 0.8::DOUBLE WHEN contains(s, t) OR contains(t, s) THEN 0.6::DOUBLE END),
    lambda r: r IS NOT NULL)[1], 0.0::DOUBLE))) / greatest(len(wa), len(wb)) END AS w,
  1.0::DOUBLE - levenshtein(a, b)::DOUBLE / greatest(length(a), length(b)) AS l,
  least(length(a), length(b))::DOUBLE / greatest(length(a), length(b)) AS ratio FROM {name}_p),
{name} AS (SELECT q, n, CASE WHEN a = '' OR b = '' THEN 0.0::DOUBLE WHEN a = b THEN 1.0::DOUBLE WHEN starts_with(a, b) OR starts_with(b, a) THEN ratio * 0.9::DOUBLE
  WHEN contains(a, b) OR contains(b, a) THEN ratio * 0.8::DOUBLE ELSE greatest(w * 0.7::DOUBLE + l * 0.3::DOUBLE, w, l) END AS score FROM {name}_w)"""


def semantic_sql(asked="asked", names="names", name="sm"):
    return f""", {SYNONYMS_SQL}, {name}_x AS (SELECT {EXPAND_SQL} AS m),
{name}_q AS (SELECT q, {_expanded(_meaning('q'))} AS wa FROM {asked}, {name}_x AS x),
{name}_n AS (SELECT n, {_expanded(_meaning('n'))} AS wb FROM {names}, {name}_x AS x),
{name} AS (SELECT q, n, CASE WHEN lower(q) = lower(n) THEN 1.0::DOUBLE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0.0::DOUBLE
  ELSE len(list_intersect(wa, wb))::DOUBLE / len(list_distinct(list_concat(wa, wb))) END AS score FROM {name}_q, {name}_n)"""


def best_sql(score, out, threshold, k):
    return f""", {out} AS (SELECT q AS query, n AS name, score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, n) AS INTEGER) AS rank FROM {score} WHERE score >= {threshold} QUALIFY rank <= {k})"""


def _name_of():
    """Column name a part stands for."""
    kind = F.col("p_type")
    head = F.lit("company name")
    for value, label in _COLUMN.items():
        head = F.when(kind == value, label).otherwise(head)
    return F.concat(head, F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(2)))


def _query_of():
    """Text a part asks for."""
    head = F.lit("first_name")
    for limit, label in reversed(_ASK):
        head = F.when(F.col("p_size") < limit, label).otherwise(head)
    tail = F.concat(F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(1)))
    return F.concat(head, F.when(F.col("p_type").isin("LARGE", "SMALL"), "").otherwise(tail))


def _names(crm):
    return crm.table("part").select(_name_of().alias("name"))


def _asked(crm):
    return crm.table("part").select(_query_of().alias("query"))


_PAIR = "(SELECT p_name AS q, lower(p_type) || ' ' || split_part(p_name, ' ', 2) AS n, p_partkey AS k FROM part)"


def _pairs(crm):
    other = F.concat(F.lower("p_type"), F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(2)))
    return crm.table("part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("q"), other.alias("n"))


@query("Q1_lev_sim", f"SELECT k, 1.0::DOUBLE - levenshtein(q, n)::DOUBLE / greatest(length(q), length(n)) AS sim FROM {_PAIR}")
def _(crm):
    return _pairs(crm).select("k", T.lev_sim(F.col("q"), F.col("n")).alias("sim"))


def _overlap_sql(pair):
    words = "WITH pair AS (SELECT k, q, n, lower(q) AS a, lower(n) AS b, " + _words("q") + " AS wa, " + _words("n") + f" AS wb FROM {pair})"
    return words + _OVERLAP_STEP


_OVERLAP_STEP = (
    """, s AS (SELECT *, list_sum(list_transform(wa, lambda s: coalesce(list_filter(list_transform(wb, lambda t: CASE WHEN s = t THEN 1.0::DOUBLE
      WHEN starts_with(s, t) OR starts_with(t, s) THEN 0.8::DOUBLE WHEN contains(s, t) OR contains(t, s) THEN 0.6::DOUBLE END), lambda r: r IS NOT NULL)[1], 0.0::DOUBLE))) / greatest(len(wa), len(wb)) AS w,
      1.0::DOUBLE - levenshtein(a, b)::DOUBLE / greatest(length(a), length(b)) AS l FROM pair)
    """
)


_OVERLAP = _overlap_sql(_PAIR)


@query("Q2_word_overlap", _OVERLAP + "SELECT k, round(w, 9) AS overlap FROM s")
def _(crm):
    overlap = T.word_overlap(T.split_words(F.col("q")), T.split_words(F.col("n")))
    return rounded(_pairs(crm).select("k", overlap.alias("overlap")), "overlap", digits=9)


@query(
    "Q3_fuzzy_score",
    _OVERLAP
    + """SELECT k, round(CASE WHEN a = b THEN 1.0::DOUBLE ELSE greatest(w * 0.7::DOUBLE + l * 0.3::DOUBLE, w, l) END, 9) AS score FROM s""",
)
def _(crm):
    return rounded(_pairs(crm).select("k", T.fuzzy_score(F.col("q"), F.col("n")).alias("score")), "score", digits=9)


# every branch of the score: equal but for case, beginning, inside, empty, missing, and the mix
_BRANCHED = """(SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 5 THEN NULL ELSE p_name END AS q, CASE p_partkey % 7 WHEN 0 THEN upper(p_name) WHEN 1 THEN split_part(p_name, ' ', 1)
  WHEN 2 THEN 'the ' || p_name || '!' WHEN 3 THEN '' WHEN 4 THEN p_name || ' ' || p_type ELSE lower(p_type) || ' ' || split_part(p_name, ' ', 2) END AS n FROM part)"""


@query(
    "Q3_fuzzy_score_branches",
    _overlap_sql(_BRANCHED)
    + """, r AS (SELECT *, least(length(a), length(b))::DOUBLE / greatest(length(a), length(b)) AS ratio FROM s)
    SELECT k, round(CASE WHEN q IS NULL OR n IS NULL OR q = '' OR n = '' THEN 0.0::DOUBLE WHEN a = b THEN 1.0::DOUBLE WHEN starts_with(a, b) OR starts_with(b, a) THEN ratio * 0.9::DOUBLE
      WHEN contains(a, b) OR contains(b, a) THEN ratio * 0.8::DOUBLE ELSE greatest(w * 0.7::DOUBLE + l * 0.3::DOUBLE, w, l) END, 9) AS score FROM r""",
)
def _(crm):
    name, kind, which = F.col("p_name"), F.col("p_type"), F.col("p_partkey") % 7
    word = lambda i: F.split_part(name, F.lit(" "), F.lit(i))
    other = (
        F.when(which == 0, F.upper(name))
        .when(which == 1, word(1))
        .when(which == 2, F.concat(F.lit("the "), name, F.lit("!")))
        .when(which == 3, "")
        .when(which == 4, F.concat_ws(" ", name, kind))
        .otherwise(F.concat_ws(" ", F.lower(kind), word(2)))
    )
    pairs = crm.table("part").select(
        F.col("p_partkey").alias("k"), F.when(which != 5, name).alias("q"), other.alias("n")
    )
    return rounded(pairs.select("k", T.fuzzy_score(F.col("q"), F.col("n")).alias("score")), "score", digits=9)


@query("Q4_fuzzy_join", NAMES_SQL + fuzzy_sql() + best_sql("fz", "best", 0.3, 10) + "SELECT query, name, round(score, 9) AS score, rank FROM best")
def _(crm):
    return rounded(M.fuzzy_join(_asked(crm), _names(crm)), "score", digits=9)


@query(
    "Q5_expand_words",
    NAMES_SQL
    + f""", {SYNONYMS_SQL}, x AS (SELECT {EXPAND_SQL} AS m), e AS (SELECT q, unnest({_expanded(_meaning('q'))}) AS word FROM asked, x) SELECT q AS query, word FROM e""",
)
def _(crm):
    words = T.expand_words(T.meaningful_words(F.col("query")))
    return _asked(crm).distinct().select("query", F.explode(words).alias("word"))


@query(
    "Q6_semantic_score",
    NAMES_SQL
    + semantic_sql()
    + ", rows AS (SELECT p_partkey AS k, CASE p_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _COLUMN.items())
    + " ELSE 'company name' END || ' ' || split_part(p_name, ' ', 2) AS n, CASE "
    + " ".join(f"WHEN p_size < {k} THEN '{v}'" for k, v in _ASK)
    + " ELSE 'first_name' END || CASE WHEN p_type IN ('LARGE', 'SMALL') THEN '' ELSE ' ' || split_part(p_name, ' ', 1) END AS q FROM part)"
    + " SELECT k, round(score, 9) AS score FROM rows JOIN sm USING (q, n)",
)
def _(crm):
    part = crm.table("part").select(
        F.col("p_partkey").alias("k"), _name_of().alias("name"), _query_of().alias("query")
    )
    score = T.semantic_score(F.col("query"), F.col("name"))
    return rounded(part.select("k", score.alias("score")), "score", digits=9)


@query("Q7_semantic_join", NAMES_SQL + semantic_sql() + best_sql("sm", "best", 0.1, 10) + "SELECT query, name, round(score, 9) AS score, rank FROM best")
def _(crm):
    return rounded(M.semantic_join(_asked(crm), _names(crm)), "score", digits=9)


@query(
    "Q8_combined_join",
    NAMES_SQL + fuzzy_sql() + semantic_sql() + best_sql("fz", "bf", 0.3, 20) + best_sql("sm", "bs", 0.1, 20)
    + """, c AS (SELECT query, name, coalesce(bf.score, 0.0) * 0.7::DOUBLE + coalesce(bs.score, 0.0) * 0.3::DOUBLE AS score, bf.rank AS fr, bs.rank AS sr,
      CASE WHEN bs.score IS NULL THEN 'fuzzy' WHEN bf.score IS NULL THEN 'semantic' ELSE 'combined' END AS match_type FROM bf FULL OUTER JOIN bs USING (query, name))
    SELECT query, name, round(score, 9) AS score, match_type, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, fr NULLS LAST, sr) AS INTEGER) AS rank FROM c QUALIFY rank <= 10""",
)
def _(crm):
    return rounded(M.combined_join(_asked(crm), _names(crm)), "score", digits=9)


@query("Q9_suggest", NAMES_SQL + fuzzy_sql() + best_sql("fz", "best", 0.4, 5) + "SELECT query, name, round(score, 9) AS score, rank FROM best")
def _(crm):
    return rounded(M.suggest(_asked(crm), _names(crm)), "score", digits=9)


@query(
    "Q9_suggest_two_lists",
    NAMES_SQL + fuzzy_sql() + semantic_sql() + best_sql("fz", "bf", 0.3, 5) + best_sql("sm", "bs", 0.1, 5)
    + """SELECT query, name, round(score, 9) AS score, rank, 'fuzzy' AS kind FROM bf UNION ALL
      SELECT query, name, round(score, 9), rank, 'semantic' FROM bs WHERE (query, name) NOT IN (SELECT (query, name) FROM bf)""",
)
def _(crm):
    return rounded(M.suggest_two_lists(_asked(crm), _names(crm)), "score", digits=9)


@query(
    "Q10_search_fields",
    NAMES_SQL + ", fields AS (SELECT DISTINCT name AS n FROM custom_fields)" + fuzzy_sql("asked", "fields") + best_sql("fz", "best", 0.3, 10)
    + """SELECT b.query, b.name, f.id, f.component, round(b.score, 9) AS score FROM best b JOIN custom_fields f ON f.name = b.name""",
)
def _(crm):
    found = M.search_fields(crm.custom_fields.select("name", "id", "component"), _asked(crm))
    return rounded(found, "score", digits=9).drop("rank")


DISPLAY = {"donation total": "gift amount ring", "Company Name": "company name gear", "first_name": "phone number rod"}


@query(
    "Q11_suggest_mapped",
    NAMES_SQL
    + ", mapped AS (SELECT q, n, translate(lower(q), ' _', '') AS a, translate(lower(n), ' _', '') AS b, CASE q "
    + " ".join(f"WHEN '{d}' THEN '{a}'" for d, a in DISPLAY.items())
    + """ END AS api FROM asked, names), s AS (SELECT q, n, CASE WHEN n = api THEN 3.0::DOUBLE WHEN contains(b, a) OR contains(a, b) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM mapped)"""
    + best_sql("s", "best", 1.0, 5)
    + "SELECT query, name, score, rank FROM best",
)
def _(crm):
    return M.suggest_mapped(_asked(crm), _names(crm), DISPLAY)


@query(
    "Q12_accept_field",
    NAMES_SQL + ", st AS (SELECT n FROM names WHERE starts_with(n, 'event')), dy AS (SELECT DISTINCT p_name AS n FROM part), fields AS (SELECT n FROM st UNION SELECT n FROM dy), "
    + "ask AS (SELECT q FROM asked UNION SELECT n FROM names UNION SELECT p_name FROM part UNION SELECT CAST(p_partkey AS VARCHAR) FROM part)"
    + fuzzy_sql("ask", "fields") + semantic_sql("ask", "fields") + best_sql("fz", "bf", 0.7, 1) + best_sql("sm", "bs", 0.3, 1)
    + """SELECT ask.q AS query, CASE WHEN regexp_full_match(ask.q, '\\d+') THEN 'custom_id' WHEN st.n IS NOT NULL THEN 'static' WHEN dy.n IS NOT NULL THEN 'dynamic'
      WHEN bf.name IS NOT NULL THEN 'fuzzy' WHEN bs.name IS NOT NULL THEN 'semantic' ELSE 'rejected' END AS accepted_by,
      CASE WHEN regexp_full_match(ask.q, '\\d+') OR st.n IS NOT NULL OR dy.n IS NOT NULL THEN ask.q ELSE coalesce(bf.name, bs.name) END AS field
      FROM ask LEFT JOIN st ON st.n = ask.q LEFT JOIN dy ON dy.n = ask.q LEFT JOIN bf ON bf.query = ask.q LEFT JOIN bs ON bs.query = ask.q""",
)
def _(crm):
    names = _names(crm)
    part = crm.table("part")
    asked = (
        _asked(crm)
        .union(names)
        .union(part.select("p_name"))
        .union(part.select(F.col("p_partkey").cast("string")))
    )
    static = names.where(F.startswith("name", F.lit("event")))
    return M.accept_field(asked, static, part.select(F.col("p_name").alias("name")))


WHOLE_NAMES = "WITH names AS (SELECT DISTINCT c_name AS n FROM customer UNION SELECT p_name FROM part), asked AS (SELECT DISTINCT p_name AS q FROM part)"


@query("Q4_fuzzy_join_names", WHOLE_NAMES + fuzzy_sql() + best_sql("fz", "best", 0.3, 10) + "SELECT query, name, round(score, 9) AS score, rank FROM best")
def _(crm):
    """Whole part names against all customer and part names."""
    parts = crm.table("part").select(F.col("p_name").alias("query"))
    names = crm.table("customer").select(F.col("c_name").alias("name")).union(crm.table("part").select("p_name"))
    return rounded(M.fuzzy_join(parts, names), "score", digits=9)


WHOLE_TEXTS = "WITH names AS (SELECT DISTINCT text AS n FROM documents WHERE text <> ''), asked AS (SELECT DISTINCT text AS q FROM benchmark WHERE text <> '')"


@query(
    "Q7_semantic_join_texts",
    WHOLE_TEXTS + semantic_sql() + best_sql("sm", "best", 0.1, 10) + "SELECT md5(query) AS query, md5(name) AS name, round(score, 9) AS score, rank FROM best",
)
def _(crm):
    """Whole benchmark passages against whole documents; long texts are shown by their digest."""
    asked = crm.table("benchmark").select(F.col("text").alias("query"))
    found = M.semantic_join(asked, crm.table("documents").select(F.col("text").alias("name")))
    return rounded(found.select(F.md5("query").alias("query"), F.md5("name").alias("name"), "score", "rank"), "score", digits=9)
