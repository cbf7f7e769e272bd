"""DuckDB SQL of the dealt queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from .repetition import DUP_SHARES, LINE_SHARE, TOP_SHARES

_WORD = r"[^\x20\x09-\x0D]+"


def repetition_sql() -> str:
    """Windows as strings of words; a word is covered if a marked window began up to n - 1 words before."""
    lengths = sorted({3, *TOP_SHARES, *DUP_SHARES})
    steps = []
    for n in lengths:
        gram = " || ' ' || ".join(["w", *[f"lead(w, {j}) OVER o" for j in range(1, n)]])
        steps.append(
            f"g{n} AS (SELECT r, i, c, count(*) OVER (PARTITION BY r, g) AS times, "
            f"row_number() OVER (PARTITION BY r, g ORDER BY i) AS nth, length(replace(g, ' ', '')) AS size, g "
            f"FROM (SELECT r, i, c, {gram} AS g FROM w WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE g IS NOT NULL)")

        def covered(mark: str, value: str) -> str:
            return (f"SELECT r, CAST(sum(CASE WHEN hit > 0 THEN {value} ELSE 0 END) AS BIGINT) AS x FROM ("
                    f"SELECT w.r, w.c, max(CASE WHEN {mark} THEN 1 ELSE 0 END) OVER (PARTITION BY w.r ORDER BY w.i "
                    f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS hit "
                    f"FROM w LEFT JOIN g{n} g ON g.r = w.r AND g.i = w.i) GROUP BY r")

        if n == 3:
            steps.append(f"rep AS ({covered('g.times > 1', '1')})")
        if n in TOP_SHARES:
            steps.append(f"t{n} AS (SELECT r, max(times * size) AS x FROM g{n} WHERE times > 1 GROUP BY r)")
        if n in DUP_SHARES:
            steps.append(f"d{n} AS ({covered('g.nth > 1', 'c')})")
    tops = [f"coalesce(t{n}.x, 0) AS top_{n}" for n in sorted(TOP_SHARES)]
    dups = [f"coalesce(d{n}.x, 0) AS dup_{n}" for n in sorted(DUP_SHARES)]
    joins = " ".join(f"LEFT JOIN {p}{n} ON {p}{n}.r = b.r" for p, s in (("t", TOP_SHARES), ("d", DUP_SHARES))
                     for n in sorted(s))
    limits = [f"top_{n} > {s} * word_chars" for n, s in TOP_SHARES.items()]
    limits += [f"dup_{n} > {s} * word_chars" for n, s in DUP_SHARES.items()]
    limits.append(f"dup_line_chars > {LINE_SHARE} * word_chars")
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT r, w, i, length(w) AS c FROM (
            SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
            FROM (SELECT r, regexp_extract_all(t, '{_WORD}') AS ws FROM d))),
        lines AS (SELECT r, line, row_number() OVER (PARTITION BY r, line) AS nth FROM (
            SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}')),
        l AS (SELECT r, count(*) AS n, CAST(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS BIGINT) AS x
              FROM lines WHERE nth > 1 GROUP BY r),
        n AS (SELECT r, count(*) AS n, CAST(sum(c) AS BIGINT) AS c FROM w GROUP BY r),
        {", ".join(steps)},
        m AS (SELECT b.doc_id, coalesce(n.n, 0) AS n_words, coalesce(n.c, 0) AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
                     coalesce(l.x, 0) AS dup_line_chars, coalesce(rep.x, 0) AS n_repeat_words,
                     {", ".join(tops + dups)}
              FROM d b LEFT JOIN n ON n.r = b.r LEFT JOIN l ON l.r = b.r
              LEFT JOIN rep ON rep.r = b.r {joins}),
        v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
        SELECT *, NOT (base_failed OR {" OR ".join(limits)}) AS kept FROM v"""


COLLOCATION_SQL = r"""
    WITH p AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    f AS (
        SELECT lang, k, g, count(*) AS f FROM (
            SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
                                                  lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS g
            FROM p, (VALUES (1), (2), (3)) AS s(k) WHERE len(ws) >= k) GROUP BY ALL),
    n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
    inner_pairs AS (
        SELECT lang, ws[1] || ' ' || ws[2] AS g, a FROM c WHERE k = 3 UNION ALL
        SELECT lang, ws[2] || ' ' || ws[3], a FROM c WHERE k = 3),
    kept AS (
        SELECT c.* FROM c LEFT JOIN (SELECT lang, g, max(a) AS of FROM inner_pairs GROUP BY ALL) i
            ON c.k = 2 AND i.lang = c.lang AND i.g = c.g
        WHERE i.of IS NULL OR 100 * i.of < 50 * c.a),
    cuts AS (
        SELECT kept.*, cut, array_to_string(ws[1:cut], ' ') AS head, array_to_string(ws[cut + 1:], ' ') AS tail
        FROM kept, (VALUES (1), (2)) AS s(cut) WHERE cut < k),
    scored AS (
        SELECT cuts.lang, cuts.g AS phrase, cuts.a, cuts.cut, h.f AS l, t.f AS r,
               CAST((CAST(1000000 AS HUGEINT) * cuts.a * cuts.a) // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
        FROM cuts JOIN f h ON h.lang = cuts.lang AND h.g = cuts.head AND h.k = cuts.cut
        JOIN f t ON t.lang = cuts.lang AND t.g = cuts.tail AND t.k = cuts.k - cuts.cut),
    least AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS "rank",
               phrase, a, l, r, score FROM least)
    SELECT lang, "rank", phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE "rank" <= 2000"""
