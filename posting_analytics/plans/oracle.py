"""DuckDB SQL for each driver query (the correctness oracle).

The SQL and its patterns are written apart from the Spark code: list functions and
window functions in DuckDB, and exact integer arithmetic for half-up
percentages.  Regexes are RE2-safe (no look-around, no back-references in
patterns) and use the same explicit whitespace class as the Spark side.
"""

from __future__ import annotations

from .. import vocab
from . import params as P

# HTML as the test pages hold it, written apart from the Spark expressions: plain tags,
# double-quoted attributes, five named references.
BLOCKS = r"(?is)<(?:script|style|template)\b[^>]*>.*?</(?:script|style|template)>|<!--.*?-->|<![^>]*>"
ANY_TAG = r"</?[A-Za-z][^>]*>"
FIRST_H1 = r"(?s)<h1>.*?</h1>"
LINK_TARGETS = r'<a href="([^"]*)"'
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"),
              ("&amp;", "&"))


def first_link(part: str) -> str:
    return rf'(?s)<a href="[^"]*{part}[^"]*">.*?</a>'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm(x: str) -> str:
    return f"coalesce(trim(regexp_replace({x}, {lit(vocab.WS + '+')}, ' ', 'g')), '')"


def decode(x: str) -> str:
    for raw, text in REFERENCES:
        x = f"replace({x}, {lit(raw)}, {lit(text)})"
    return x


def strip_tags(x: str, rep: str) -> str:
    return f"regexp_replace({x}, {lit(ANY_TAG)}, {lit(rep)}, 'g')"


def html_to_text(x: str) -> str:
    body = f"regexp_replace({x}, {lit(BLOCKS)}, ' ', 'g')"
    return norm(decode(strip_tags(body, " ")))


def element_text(html: str, pattern: str, sentinel: str = vocab.NOT_FOUND) -> str:
    m = f"regexp_extract({html}, {lit(pattern)}, 0)"
    return (f"CASE WHEN {html} IS NULL OR {m} = '' THEN {lit(sentinel)} "
            f"ELSE {norm(decode(strip_tags(m, '')))} END")


def ordered_case(t: str, rules, default: str) -> str:
    whens = " ".join(f"WHEN contains(lower({t}), {lit(k.lower())}) THEN {lit(v)}" for k, v in rules)
    return f"CASE {whens} ELSE {lit(default)} END"


def first_listed(t: str, words, sentinel: str = vocab.NOT_FOUND) -> str:
    return ordered_case(t, [(w, w.title()) for w in words], sentinel)


def regex_first(t: str, pattern: str, sentinel: str = vocab.NOT_FOUND) -> str:
    return f"coalesce(nullif(regexp_extract({t}, {lit(pattern)}, 0), ''), {lit(sentinel)})"


def _word_hit(t: str, w: str, whole_word: bool) -> str:
    if not whole_word:
        return f"contains(lower({t}), {lit(w.lower())})"
    esc = "".join("\\" + ch if ch in ".^$|?*+()[]{}\\/" else ch for ch in w.lower())
    return f"regexp_matches(lower({t}), {lit('(^|[^a-z0-9_])' + esc + '($|[^a-z0-9_])')})"


def keyword_tags(t: str, words, k: int = vocab.MAX_SKILLS, sentinel: str = vocab.NOT_FOUND,
                 whole_word: bool = False) -> str:
    items = ", ".join(f"CASE WHEN {_word_hit(t, w, whole_word)} THEN {lit(w)} END" for w in words)
    hits = f"list_filter([{items}], lambda x: x IS NOT NULL)"
    return (f"CASE WHEN len({hits}) = 0 THEN {lit(sentinel)} "
            f"ELSE array_to_string(({hits})[1:{k}], ', ') END")


def canon(d: str) -> str:
    s = f"regexp_replace({d}, '^0+', '')"
    return f"CASE WHEN {s} = '' AND {d} <> '' THEN '0' ELSE {s} END"


def group3(c: str) -> str:
    return f"ltrim(reverse(regexp_replace(reverse({c}), '([0-9]{{3}})', '\\1.', 'g')), '.')"


def money_format(t: str) -> str:
    d = f"regexp_replace({t}, '[^0-9]', '', 'g')"
    return f"CASE WHEN {d} = '' THEN {t} ELSE 'Rp. ' || {group3(canon(d))} END"


def amount_range(t: str, pattern: str, min_digits: int = vocab.SALARY_MIN_DIGITS,
                 sentinel: str = vocab.NOT_STATED, drop_fraction: bool = False) -> str:
    found = f"regexp_extract_all(coalesce({t}, ''), {lit(pattern)}, 0)"
    if drop_fraction:
        found = f"list_transform({found}, lambda m: regexp_replace(m, ',[0-9]+$', ''))"
    digits = f"list_transform({found}, lambda x: regexp_replace(x, '[^0-9]', '', 'g'))"
    kept = f"list_filter({digits}, lambda d: length(d) >= {min_digits})"
    canon_l = f"list_transform({kept}, lambda d: {canon('d')})"
    padded = f"list_sort(list_distinct(list_transform({canon_l}, lambda d: lpad(d, 400, '0'))))"
    unpad = lambda x: f"CASE WHEN ltrim({x}, '0') = '' THEN '0' ELSE ltrim({x}, '0') END"
    lo = f"'Rp. ' || {group3(unpad(f'({padded})[1]'))}"
    hi = f"'Rp. ' || {group3(unpad(f'({padded})[-1]'))}"
    n = f"len({padded})"
    return (f"CASE WHEN {n} = 0 THEN {lit(sentinel)} WHEN {n} = 1 THEN {lo} "
            f"ELSE {lo} || ' - ' || {hi} END")


def pct(n: str, t: str, scale: int = 2) -> str:
    """Exact half-up ``round(n * 100 / t, scale)`` as double (NULL when t = 0)."""
    f = 10 ** (scale + 2)
    return (f"CAST((CAST({n} AS HUGEINT) * {2 * f} + CAST({t} AS HUGEINT)) // "
            f"(2 * CAST(nullif({t}, 0) AS HUGEINT)) AS DOUBLE) / {10 ** scale}")


_NULLIFIED = (f"(SELECT o_orderkey, nullif(o_orderstatus, {lit(P.STATUS_SENTINEL)}) AS o_orderstatus, "
              f"nullif(o_orderpriority, {lit(P.PRIORITY_SENTINEL)}) AS o_orderpriority FROM orders)")

_PART_FLAGS = (f"(SELECT *, CAST(p_size > {P.PART_SIZE_CUT} AS INTEGER) AS big_size, "
               f"CAST(p_retailprice > {P.PART_PRICE_CUT} AS INTEGER) AS premium FROM part)")


def _value_share(table: str, key: str) -> str:
    return (f"WITH g AS (SELECT {key}, count(*) AS n FROM {table} GROUP BY {key}) "
            f"SELECT {key}, n, {pct('n', '(SELECT CAST(sum(n) AS BIGINT) FROM g)')} AS pct FROM g")


# every real page, and copies of some without HTML beside them
_AND_EMPTY = (f"(SELECT page_id, url, html FROM pages UNION ALL "
              f"SELECT page_id, url, CASE WHEN page_id % {P.PAGE_REJECT_EVERY} = 1 THEN '' END "
              f"FROM pages WHERE page_id % {P.PAGE_REJECT_EVERY} < 2)")


def _extract_postings(source: str = _AND_EMPTY) -> str:
    pt = "page_text"
    cols = {
        "job_title": element_text("html", FIRST_H1),
        "company_name": element_text("html", first_link(P.PAGE_HREF)),
        "location": first_listed(pt, P.DOC_FIRST_WORDS),
        "job_type": ordered_case(pt, [(P.PAGE_PHRASE, vocab.FULL_TIME_LABEL)], vocab.NOT_FOUND),
        "experience_level": regex_first(f"lower({pt})", P.PAGE_LOWER_PATTERN),
        "education_req": regex_first(pt, P.PAGE_CASE_PATTERN),
        "salary_range": amount_range(pt, P.PAGE_AMOUNT_PATTERN),
        "job_requirements": keyword_tags(pt, P.DOC_TAG_WORDS),
        "job_responsibilities": ordered_case(pt, P.DOC_LABELS, vocab.NOT_FOUND),
        "posted_date": lit(P.RUN_DATE),
        "source_platform": lit(vocab.SOURCE_PLATFORM),
    }
    select = ", ".join(f"{expr} AS {name}" for name, expr in cols.items())
    return (f"WITH p AS (SELECT page_id, html, {html_to_text('html')} AS page_text FROM {source} "
            f"WHERE html IS NOT NULL AND length(html) > 0) SELECT page_id, {select} FROM p")


def _page_location_share() -> str:
    nf = lit(vocab.NOT_FOUND)
    postings = _extract_postings("pages")
    kept = (f"SELECT location || ' / ' || {ordered_case('job_title', vocab.CATEGORY_RULES, vocab.CATEGORY_DEFAULT)} "
            f"AS location_category FROM ({postings}) WHERE job_title <> {nf} AND company_name <> {nf} "
            f"AND job_requirements <> {nf} AND job_responsibilities <> {nf} AND location <> {nf}")
    return _value_share(f"({kept})", "location_category")


def _links() -> str:
    return (f"SELECT DISTINCT {lit(vocab.SITE_ROOT)} || {decode('h')} AS url FROM "
            f"(SELECT unnest(regexp_extract_all(html, {lit(LINK_TARGETS)}, 1)) AS h FROM pages) "
            f"WHERE contains({decode('h')}, {lit(P.PAGE_HREF)})")


def _missing_rate() -> str:
    a = (f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderpriority IS NULL) AS m0, "
         f"count(*) FILTER (WHERE o_orderstatus IS NULL) AS m1 FROM {_NULLIFIED}")
    return (f"WITH a AS ({a}) "
            f"SELECT 'o_orderpriority' AS column_name, m0 AS n_missing, n_rows, "
            f"{pct('m0', 'n_rows')} AS pct_missing FROM a UNION ALL "
            f"SELECT 'o_orderstatus', m1, n_rows, {pct('m1', 'n_rows')} FROM a")


def _cluster_summary() -> str:
    p = (f"SELECT p_type AS c, p_brand, p_name, CAST(p_size AS VARCHAR) AS p_size, premium "
         f"FROM {_PART_FLAGS}")

    def counts(col):
        return (f"SELECT c, {col} AS v, count(*) AS n FROM p WHERE {col} IS NOT NULL "
                f"GROUP BY c, {col}")

    def ranked(col):
        return f"SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, v) AS r FROM ({counts(col)})"

    return (
        f"WITH p AS ({p}), "
        f"tot AS (SELECT c, count(*) AS total_lowongan, sum(premium) AS yes, count(premium) AS flagged "
        f"FROM p GROUP BY c), "
        f"rc AS ({ranked('p_brand')}), rl AS ({ranked('p_name')}), re AS ({ranked('p_size')}), "
        f"mc AS (SELECT c, v FROM rc WHERE r = 1), ml AS (SELECT c, v FROM rl WHERE r = 1), "
        f"me AS (SELECT c, v FROM re WHERE r = 1), "
        f"dc AS (SELECT c, string_agg(v || ':' || n, ', ' ORDER BY n DESC, v) AS s FROM rc GROUP BY c), "
        f"dl AS (SELECT c, string_agg(v || ':' || n, ', ' ORDER BY n DESC, v) AS s FROM rl "
        f"WHERE r <= 5 GROUP BY c) "
        f"SELECT tot.c AS cluster_id, total_lowongan, mc.v AS kategori_dominan, ml.v AS lokasi_dominan, "
        f"me.v AS pendidikan_dominan, {pct('coalesce(yes, 0)', 'flagged', 1)} AS pct_gaji_dicantumkan, "
        f"dc.s AS distribusi_kategori, dl.s AS distribusi_lokasi "
        f"FROM tot LEFT JOIN mc USING (c) LEFT JOIN ml USING (c) LEFT JOIN me USING (c) "
        f"LEFT JOIN dc USING (c) LEFT JOIN dl USING (c)")


def _table_profile() -> str:
    cols = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
            ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
    sentinels = ", ".join(lit(s) for s in (P.PRIORITY_SENTINEL, vocab.NOT_FOUND))
    parts = [f"SELECT {lit(c)} AS column_name, {lit(t)} AS data_type, count(*) AS n_rows, "
             f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
             f"count(*) FILTER (WHERE CAST({c} AS VARCHAR) IN ({sentinels})) AS n_sentinel, "
             f"count(DISTINCT {c}) AS n_distinct FROM orders" for c, t in cols]
    return " UNION ALL ".join(parts)


def _top_custkeys(k: int) -> str:
    return f"SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT {k}"


def _pivot_counts() -> str:
    cells = ", ".join(f"count(*) FILTER (WHERE o_orderpriority = {lit(v)}) AS \"{v}\""
                      for v in P.PRIORITIES)
    return f"SELECT o_orderstatus, {cells} FROM orders GROUP BY o_orderstatus"


def _pivot_top(table: str, row: str, col: str, k: int) -> str:
    return (f"WITH t AS (SELECT {col} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) AS INTEGER) AS \"rank\" "
            f"FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY 2 LIMIT {k}), "
            f"r AS (SELECT DISTINCT {row} FROM {table} WHERE {col} IN (SELECT v FROM t)) "
            f"SELECT r.{row}, t.\"rank\", t.v AS {col}, (SELECT count(*) FROM {table} o "
            f"WHERE o.{row} IS NOT DISTINCT FROM r.{row} AND o.{col} = t.v) AS n FROM r, t")


def _binary_split() -> str:
    a = f"SELECT p_brand, CAST(sum(big_size) AS BIGINT) AS y, count(*) AS t FROM {_PART_FLAGS} GROUP BY p_brand"
    return (f"WITH a AS ({a}) "
            f"SELECT p_brand, 'yes' AS answer, y AS n, {pct('y', 't', 1)} AS pct FROM a UNION ALL "
            f"SELECT p_brand, 'no' AS answer, t - y AS n, {pct('t - y', 't', 1)} AS pct FROM a")


def _standardize() -> str:
    def z(c):
        return f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS z_{c}"
    return f"SELECT p_partkey, {z('p_size')}, {z('p_retailprice')} FROM part"


_SINKS = "(VALUES ('csv'), ('json'), ('parquet')) AS s(sink)"


def _text_roundtrip() -> str:
    hard = ("CASE doc_id % 5 WHEN 0 THEN ' \"' || text || '\"' || chr(10) "
            "WHEN 3 THEN '\\,' || text || chr(13) || chr(10) || ' ' ELSE text END")
    rows = (f"SELECT doc_id, {hard} AS t FROM documents UNION ALL "
            f"SELECT -1 - doc_id, CASE WHEN doc_id % 5 = 1 THEN '' END FROM documents WHERE doc_id % 5 IN (1, 2)")
    return (f"SELECT sink, doc_id, CAST(coalesce(length(t), -1) AS INTEGER) AS n, md5(coalesce(t, 'NULL')) AS digest "
            f"FROM ({rows}) CROSS JOIN {_SINKS}")


def _feature_vectors() -> str:
    def codes(col):
        return (f"SELECT {col}, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS DOUBLE) AS i "
                f"FROM part GROUP BY {col}")

    def z(c):
        return f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6)"

    return (f"WITH t AS ({codes('p_type')}), b AS ({codes('p_brand')}), "
            f"x AS (SELECT p_partkey, t.i AS t, b.i AS b, CAST(p_size AS DOUBLE) AS s FROM part "
            f"JOIN t USING (p_type) JOIN b USING (p_brand)) "
            f"SELECT p_partkey, {z('t')} AS z0, {z('b')} AS z1, {z('s')} AS z2 FROM x")


# Eigenvalues of a 2 x 2 covariance matrix [[a, b], [b, c]]; vectors (b, l - a) normed, second entry positive.
_EIGEN = ("e AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c, avg(x) AS mx, avg(y) AS my FROM p), "
          "l AS (SELECT *, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l1, "
          "(a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b) AS l2 FROM e), "
          "v AS (SELECT *, b * sign(l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS x1, "
          "abs(l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS y1, "
          "b * sign(l2 - a) / sqrt(b * b + (l2 - a) * (l2 - a)) AS x2, "
          "abs(l2 - a) / sqrt(b * b + (l2 - a) * (l2 - a)) AS y2 FROM l)")
_PLANE = "p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, CAST(p_retailprice AS DOUBLE) AS y FROM part)"

_POINTS = ("x AS (SELECT l_returnflag AS f, ascii(l_returnflag) * 10000.0 + l_quantity AS x FROM lineitem), "
           "g AS (SELECT f, count(*) AS n, avg(x) AS m, avg(x * x) AS q, min(x) AS low FROM x GROUP BY f)")


def _quality_groups() -> str:
    """Cost about the group means; mean of (b - a) / max(a, b) with mean squared distances a to the
    own group (without the point) and b to the nearest other one."""
    return (f"WITH {_POINTS}, w AS (SELECT f, x, count(*) AS c FROM x GROUP BY f, x), "
            f"d AS (SELECT w.f, w.x, c, g.f = w.f AS own, g.n, w.x * w.x - 2 * w.x * g.m + g.q AS d FROM w, g), "
            f"a AS (SELECT f, x, c, min(d) FILTER (NOT own) AS b, max(d * n / nullif(n - 1, 0)) FILTER (own) AS a "
            f"FROM d GROUP BY f, x, c) "
            f"SELECT CAST((SELECT count(*) FROM g) AS INTEGER) AS k, "
            f"(SELECT round(sum((x.x - g.m) * (x.x - g.m)), 2) FROM x JOIN g USING (f)) AS training_cost, "
            f"round(sum(c * CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) / sum(c), 8) AS silhouette "
            f"FROM a")


def _elbow_groups() -> str:
    """k = 3 keeps the places apart; k = 2 joins the two that lie close."""
    places = ", ".join(f"({lit(v)}, {at})" for v, at in P.PRIORITY_PLACES.items())
    near = sorted(set(P.PRIORITY_PLACES.values()))[1]
    cost = "SELECT {k} AS k, round(sum((x - m) * (x - m)), 1) AS wssse FROM (SELECT x, avg(x) OVER (PARTITION BY {by}) AS m FROM x)"
    return (f"WITH v(p, place) AS (VALUES {places}), x AS (SELECT CAST(place AS DOUBLE) AS place, "
            f"CAST(place + o_orderkey % 5 AS DOUBLE) AS x FROM orders JOIN v ON o_orderpriority = p) "
            f"{cost.format(k=2, by=f'place <= {near}')} UNION ALL {cost.format(k=3, by='place')}")


def oracle_sql() -> dict[str, str]:
    s = vocab.NOT_FOUND
    return {
        "normalize_ws": f"SELECT doc_id, {norm('text')} AS text_norm FROM documents",
        "html_text": f"SELECT page_id, {html_to_text('html')} AS page_text FROM pages",
        "html_h1": f"SELECT page_id, {element_text('html', FIRST_H1)} AS job_title FROM pages",
        "html_anchor": (f"SELECT page_id, {element_text('html', first_link(P.PAGE_HREF))} "
                        f"AS company_name FROM pages"),
        "first_match": f"SELECT doc_id, {first_listed('text', P.DOC_FIRST_WORDS)} AS first_word FROM documents",
        "flag_text": (f"SELECT doc_id, {ordered_case('text', [(P.DOC_FLAG_PHRASE, P.DOC_FLAG_LABEL)], s)} "
                      f"AS license_flag FROM documents"),
        "regex_first": (f"SELECT doc_id, {regex_first('text', P.DOC_REF_PATTERN)} AS first_ref, "
                        f"{regex_first('lower(text)', P.DOC_LOWER_PATTERN)} AS first_phrase, "
                        f"{regex_first('text', P.DOC_CASE_PATTERN)} AS first_grade FROM documents"),
        "amount_range": (f"SELECT doc_id, {amount_range('text', P.DOC_AMOUNT_PATTERN)} AS amount_range "
                         f"FROM documents"),
        "amount_range_no_fraction": (
            f"SELECT doc_id, {amount_range('text', P.DOC_AMOUNT_PATTERN, drop_fraction=True)} "
            f"AS amount_range FROM documents"),
        "keyword_tags_whole_word": (f"SELECT doc_id, {keyword_tags('text', P.DOC_TAG_WORDS, whole_word=True)} "
                                    f"AS tags FROM documents"),
        "money_format": (f"SELECT o_orderkey, {money_format(chr(39) + 'IDR ' + chr(39) + ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)')} "
                         f"AS price_text FROM orders"),
        "keyword_tags": f"SELECT doc_id, {keyword_tags('text', P.DOC_TAG_WORDS)} AS tags FROM documents",
        "keyword_label": f"SELECT doc_id, {ordered_case('text', P.DOC_LABELS, s)} AS label FROM documents",
        "const_columns": (f"SELECT o_orderkey, {lit(vocab.SOURCE_PLATFORM)} AS source_platform, "
                          f"{lit(P.RUN_DATE)} AS posted_date, {lit(P.RUN_TS)} AS scraped_at, "
                          f"{lit(vocab.DOCUMENT_SOURCE)} AS source FROM orders"),
        "link_discovery": _links(),
        "link_cap": f"SELECT url FROM ({_links()}) ORDER BY url LIMIT {P.PAGE_LINK_CAP}",
        "safe_extract": (
            f"WITH m AS (SELECT doc_id, nullif(regexp_extract(text, {lit(P.DOC_LONG_NUMBER)}, 0), '') AS h "
            f"FROM documents) SELECT doc_id, CAST(TRY_CAST(h AS BIGINT) AS VARCHAR) AS amount, "
            f"CASE WHEN h IS NOT NULL AND TRY_CAST(h AS BIGINT) IS NULL THEN 1 ELSE 0 END AS parse_error FROM m"),
        "extract_postings": _extract_postings(),
        "page_location_share": _page_location_share(),
        "attribute_counts": (
            "SELECT o_orderstatus, 'o_orderpriority' AS attribute, o_orderpriority AS value, count(*) AS n "
            "FROM orders GROUP BY 1, 2, 3 UNION ALL "
            "SELECT o_orderstatus, 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders "
            "GROUP BY 1, 2, 3"),
        "heavy_hitters": " UNION ALL ".join(
            f"(SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM lineitem "
            f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 5)"
            for c in ("l_returnflag", "l_suppkey", "l_partkey")),
        "required_filter": (
            f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders "
            f"WHERE o_orderstatus <> {lit(P.STATUS_SENTINEL)} AND o_orderpriority IS NOT NULL "
            f"AND o_orderpriority <> {lit(P.PRIORITY_SENTINEL)}"),
        "fill_nulls": (f"SELECT o_orderkey, coalesce(o_orderstatus, {lit(vocab.UNKNOWN)}) AS o_orderstatus, "
                       f"coalesce(o_orderpriority, {lit(vocab.NOT_STATED)}) AS o_orderpriority "
                       f"FROM {_NULLIFIED}"),
        "replace_value": (f"SELECT o_orderkey, CASE WHEN o_orderpriority = {lit(P.PRIORITY_SENTINEL)} "
                          f"THEN {lit(vocab.UNKNOWN)} ELSE o_orderpriority END AS o_orderpriority FROM orders"),
        "replace_null": (f"SELECT o_orderkey, nullif(o_orderstatus, {lit(P.PRIORITY_SENTINEL)}) AS o_orderstatus, "
                         f"nullif(o_orderpriority, {lit(P.PRIORITY_SENTINEL)}) AS o_orderpriority FROM orders"),
        "any_present": (f"SELECT * FROM {_NULLIFIED} WHERE coalesce(o_orderpriority, o_orderstatus) "
                        f"IS NOT NULL"),
        "missing_rate": _missing_rate(),
        "category_share": _value_share(
            f"(SELECT {ordered_case('p_name', P.PART_RULES, P.PART_DEFAULT)} AS category FROM part)",
            "category"),
        "presence_flag": (f"SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority <> "
                          f"{lit(P.PRIORITY_SENTINEL)} THEN 1 ELSE 0 END AS has_priority FROM orders"),
        "value_share": _value_share("orders", "o_orderpriority"),
        "value_share_customer": _value_share("orders", "o_custkey"),
        "topk_with_set": ("SELECT CAST(o_orderdate AS VARCHAR) AS order_day, count(*) AS n, "
                          "array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') AS priorities "
                          "FROM orders GROUP BY 1 ORDER BY n DESC, order_day LIMIT 40"),
        "status_count": (f"SELECT CASE WHEN o_orderpriority <> {lit(P.PRIORITY_SENTINEL)} "
                         f"THEN 'Priority stated' ELSE 'Priority not stated' END AS priority_status, "
                         f"count(*) AS n FROM orders GROUP BY 1"),
        "two_key_count": ("SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer "
                          "WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY c_nationkey, c_mktsegment"),
        "group_counts": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
        "distinct_counts": ("SELECT count(DISTINCT o_custkey) AS n_distinct_o_custkey, "
                            "count(DISTINCT o_orderstatus) AS n_distinct_o_orderstatus, "
                            "count(DISTINCT o_orderpriority) AS n_distinct_o_orderpriority, "
                            "count(DISTINCT o_orderdate) AS n_distinct_o_orderdate FROM orders"),
        "conditional_rate": (
            f"WITH a AS (SELECT p_brand, count(*) AS total, CAST(sum(CASE WHEN p_size > {P.PART_SIZE_CUT} "
            f"THEN 1 ELSE 0 END) AS BIGINT) AS hits FROM part GROUP BY p_brand) "
            f"SELECT p_brand, total, hits, {pct('hits', 'total', 1)} AS pct FROM a"),
        "flag_rate": (f"WITH a AS (SELECT p_type, CAST(sum(premium) AS BIGINT) AS hits, count(*) AS total "
                      f"FROM {_PART_FLAGS} GROUP BY p_type) "
                      f"SELECT p_type, hits, total, {pct('hits', 'total', 1)} AS pct FROM a"),
        "mode_per_group": (
            "WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer "
            "WHERE c_mktsegment IS NOT NULL GROUP BY 1, 2), "
            "r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS rn "
            "FROM c) SELECT c_nationkey, c_mktsegment AS mode_segment FROM r WHERE rn = 1"),
        "mean_pct": (f"SELECT p_brand, {pct('sum(big_size)', 'count(big_size)', 1)} AS pct_big "
                     f"FROM {_PART_FLAGS} GROUP BY p_brand"),
        "topn_per_group": (
            "WITH c AS (SELECT o_orderstatus, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2), "
            "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY n DESC, o_custkey) "
            "AS INTEGER) AS \"rank\" FROM c) SELECT o_orderstatus, o_custkey, n, \"rank\" FROM r "
            "WHERE \"rank\" <= 5"),
        "cluster_summary": _cluster_summary(),
        "top_companies": (
            "WITH c AS (SELECT o_orderstatus, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2), "
            "r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY n DESC, o_custkey) AS rn "
            "FROM c) SELECT o_orderstatus AS cluster_id, string_agg(CAST(o_custkey AS VARCHAR) || ':' || n, "
            "', ' ORDER BY n DESC, o_custkey) AS top_companies FROM r WHERE rn <= 5 GROUP BY o_orderstatus"),
        "sorted_distinct": "SELECT DISTINCT o_orderpriority FROM orders",
        "table_profile": _table_profile(),
        "topk_semijoin": (f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN "
                          f"({_top_custkeys(5)})"),
        "pivot_counts": _pivot_counts(),
        "pivot_top_counts": _pivot_top("orders", "o_orderpriority", "o_custkey", 5),
        "pivot_top_nulls": _pivot_top(_NULLIFIED, "o_orderstatus", "o_orderpriority", 3),
        "index_many": (
            "WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS customer, CAST(row_number() OVER (ORDER BY count(*) DESC, "
            "CAST(o_custkey AS VARCHAR)) - 1 AS DOUBLE) AS customer_idx FROM orders GROUP BY 1) "
            "SELECT o_orderkey, customer, customer_idx FROM orders JOIN r ON CAST(o_custkey AS VARCHAR) = customer"),
        "feature_vectors": _feature_vectors(),
        "pca_plane": (f"WITH {_PLANE}, {_EIGEN} SELECT p_partkey, round((x - mx) * x1 + (y - my) * y1, 4) AS pc1, "
                      f"round((x - mx) * x2 + (y - my) * y2, 4) AS pc2 FROM p, v"),
        "pca_plane_variance": (f"WITH {_PLANE}, {_EIGEN} SELECT 1 AS component, round(l1 / (l1 + l2), 8) AS ratio FROM l "
                               f"UNION ALL SELECT 2, round(l2 / (l1 + l2), 8) FROM l"),
        "kmeans_groups": (f"WITH {_POINTS} SELECT CAST(row_number() OVER (ORDER BY low) AS INTEGER) AS number, "
                          f"f AS l_returnflag, n FROM g"),
        "cluster_quality_groups": _quality_groups(),
        "elbow_groups": _elbow_groups(),
        "rejects": f"SELECT page_id, url, 'no html' AS reason FROM {_AND_EMPTY} WHERE html IS NULL OR html = ''",
        "text_roundtrip": _text_roundtrip(),
        "json_arrays": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
        "malformed_records": (
            "SELECT o_orderkey, o_custkey, o_orderpriority, CAST(NULL AS VARCHAR) AS raw FROM orders UNION ALL "
            "SELECT NULL, NULL, NULL, CASE o_orderstatus WHEN 'F' THEN concat_ws(',', o_orderkey, o_custkey) "
            "WHEN 'O' THEN concat_ws(',', o_orderkey, o_custkey, o_orderpriority, 'more') "
            "ELSE 'x' || concat_ws(',', o_orderkey, o_custkey, o_orderpriority) END FROM orders"),
        "collection_counts": ("SELECT 'orders' AS collection, count(*) AS n FROM orders UNION ALL "
                              "SELECT 'shares', count(DISTINCT o_orderpriority) FROM orders"),
        "documents_view": "SELECT * FROM customer",
        "first_rows": "SELECT * EXCLUDE (o_orderdate) FROM orders ORDER BY o_orderkey LIMIT 20",
        "binary_split": _binary_split(),
        "stack_offsets": (
            "WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) "
            "SELECT o_orderstatus, o_orderpriority, n, CAST(coalesce(sum(n) OVER (PARTITION BY o_orderstatus "
            "ORDER BY o_orderpriority ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) "
            "AS \"offset\" FROM c"),
        "index_freq": (
            "WITH f AS (SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type), "
            "r AS (SELECT p_type, CAST(row_number() OVER (ORDER BY n DESC, p_type) - 1 AS DOUBLE) AS type_idx "
            "FROM f) SELECT p_partkey, part.p_type, coalesce(r.type_idx, CAST((SELECT count(*) FROM f) "
            "AS DOUBLE)) AS type_idx FROM part LEFT JOIN r ON part.p_type = r.p_type"),
        "index_alpha": ("SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) "
                        "AS brand_idx FROM part"),
        "standardize": _standardize(),
        "sink_roundtrip": (f"SELECT sink, orders.* REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) "
                           f"FROM orders CROSS JOIN {_SINKS}"),
    }
