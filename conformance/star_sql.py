"""The star's tables as SQL over the raw tables, for use as common table expressions."""

from __future__ import annotations

from cinelake.functions.text import ENGLISH_STOP_WORDS

DATE_KEY = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INTEGER)"

TABLES = {
    "geography": """
        SELECT CAST(n_nationkey AS BIGINT) AS "Key", n_name AS "City", r_name AS "Country"
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "cust": """
        SELECT c_custkey AS "Key", split_part(c_name, '#', 1) AS "First Name",
               split_part(c_name, '#', 2) AS "Last Name", lower(c_name) || '@mail' AS "Email",
               c_mktsegment AS "Gender", CAST(c_nationkey AS BIGINT) AS "Geography Key",
               c_acctbal > 0 AS "Is Active",
               strftime(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER), '%Y-%m-%d') AS "Create Date"
        FROM customer""",
    "content": """
        SELECT p_partkey AS "Key", p_name AS "Title", CAST(p_size + 1970 AS INTEGER) AS "Release Year",
               CAST(round(p_retailprice * 100) AS BIGINT) AS "Revenue"
        FROM part""",
    "bridge": """
        SELECT p_partkey AS "Content Key", p_type AS "Category Key" FROM part
        UNION ALL SELECT p_partkey, p_brand FROM part""",
    "category": """
        SELECT DISTINCT "Category Key" AS "Key", upper("Category Key") AS "Name" FROM bridge""",
    "provider": """
        SELECT s_suppkey AS "Key", s_name AS "Name",
               CASE s_suppkey % 3 WHEN 0 THEN 'flatrate' WHEN 1 THEN 'rent' ELSE 'premium' END AS "Type"
        FROM supplier""",
    "plan": """
        SELECT DISTINCT o_orderpriority AS "Key", split_part(o_orderpriority, '-', 2) AS "Type"
        FROM orders""",
    "event": f"""
        SELECT l_orderkey * 10 + l_linenumber AS "Stream Event Key",
               {DATE_KEY.format('o_orderdate')} AS "Date Key",
               o_custkey AS "Customer Key", l_partkey AS "Content Key", l_suppkey AS "Provider Key",
               CAST(l_quantity AS BIGINT) AS "Streams Count",
               CAST(floor(l_extendedprice) AS BIGINT) AS "Minutes Watched",
               l_discount AS "Watch Percentage", l_linestatus = 'F' AS "Completion Flag"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "payment": f"""
        SELECT l_orderkey * 10 + l_linenumber AS "Payment Key",
               {DATE_KEY.format('o_orderdate')} AS "Date Key", o_custkey AS "Customer Key",
               l_suppkey AS "Provider Key", o_orderpriority AS "Subscription Plan Key",
               l_extendedprice AS "Amount", l_tax AS "Tax Amount", l_discount AS "Discount Amount"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "subscription": f"""
        SELECT l_orderkey * 10 + l_linenumber AS "Subscription Fact Key",
               {DATE_KEY.format('o_orderdate')} AS "Date Key", o_custkey AS "Customer Key",
               l_suppkey AS "Provider Key", o_orderpriority AS "Plan Key",
               {DATE_KEY.format('o_orderdate')} AS "Subscription Start Date Key",
               {DATE_KEY.format('l_shipdate')} AS "Subscription End Date Key",
               l_linestatus = 'O' AS "Is Active", o_totalprice AS "Revenue"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "availability": f"""
        SELECT l_partkey * 1000000 + l_suppkey AS "Catalog Key",
               {DATE_KEY.format('min(l_shipdate)')} AS "Date Key",
               l_partkey AS "Content Key", l_suppkey AS "Provider Key",
               {DATE_KEY.format('min(l_shipdate)')} AS "License Start Date Key",
               {DATE_KEY.format('max(l_shipdate)')} AS "License End Date Key",
               max(l_linestatus) = 'O' AS "Is Available", max(l_quantity) AS "Catalog Rank Score"
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "viewing": """
        SELECT user_id AS u, CAST(json_extract_string(props, '$.k') AS BIGINT) AS i, value AS m
        FROM events""",
    # user x item minutes, negatives clipped
    "cell": """
        SELECT u, i, sum(greatest(m, 0)) AS m FROM viewing GROUP BY u, i""",
    "seen": "SELECT u, i, m FROM cell WHERE m > 0",
    "n_users": "SELECT count(DISTINCT u) AS n FROM cell",
    "n_items": "SELECT count(DISTINCT i) AS n FROM cell",
    "popular": """
        SELECT i, round(sum(m) / (SELECT n FROM n_users), 9) AS pop,
               row_number() OVER (ORDER BY round(sum(m) / (SELECT n FROM n_users), 9) DESC, i) AS pos
        FROM cell GROUP BY i""",
    "centred": """
        SELECT u, i, c FROM (SELECT u, i, round(m - avg(m) OVER (PARTITION BY u), 9) AS c FROM seen)
        WHERE c <> 0""",
}

NOVELTY = "CASE WHEN {0} = 0 THEN 1.25 WHEN {0} < 30 THEN 1.12 WHEN {0} <= 90 THEN 1.0 ELSE 0.65 END"

STOP_LIST = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)


def cosine_sql(cells: str, row: str, feature: str, value: str) -> str:
    """Cosine of every ordered pair of rows that share a feature, as (a, b, s)."""
    return f"""
        SELECT x.{row} AS a, y.{row} AS b,
               round(greatest(-1.0, least(1.0, sum(x.{value} * y.{value}) / sqrt(any_value(nx.q) * any_value(ny.q)))), 9) AS s
        FROM {cells} x JOIN {cells} y ON x.{feature} = y.{feature} AND x.{row} <> y.{row}
        JOIN (SELECT {row} AS r, sum({value} * {value}) AS q FROM {cells} GROUP BY 1) nx ON nx.r = x.{row}
        JOIN (SELECT {row} AS r, sum({value} * {value}) AS q FROM {cells} GROUP BY 1) ny ON ny.r = y.{row}
        GROUP BY 1, 2"""


def item_scores_sql(similarity: str) -> str:
    return f"""
        SELECT u, i, sum(s * m) / sum(s) AS base FROM (
          SELECT seen.u, t.a AS i, t.s, seen.m,
                 row_number() OVER (PARTITION BY seen.u, t.a ORDER BY t.s DESC, t.b) AS rn
          FROM seen JOIN {similarity} t ON t.b = seen.i AND t.s > 0)
        WHERE rn <= 15 GROUP BY 1, 2"""


def tokens_sql(key: str, text: str, table: str) -> str:
    """Words and word pairs of each text, as (d, term)."""
    return f"""
        SELECT d, unnest(CASE WHEN nxt IS NULL THEN [w] ELSE [w, w || ' ' || nxt] END) AS term FROM (
          SELECT d, w, lead(w) OVER (PARTITION BY d ORDER BY p) AS nxt FROM (
            SELECT {key} AS d, unnest(l) AS w, generate_subscripts(l, 1) AS p FROM (
              SELECT {key}, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS l FROM {table}))
          WHERE w NOT IN ({STOP_LIST}))"""


def weights_sql(tokens: str, size: str) -> str:
    """TF-IDF weights out of (d, term), as (d, term, x)."""
    return f"""
        SELECT d, term, w / sqrt(sum(w * w) OVER (PARTITION BY d)) AS x FROM (
          SELECT d, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w
          FROM (SELECT d, term, count(*) AS tf FROM {tokens} GROUP BY 1, 2)
          JOIN (SELECT term, count(DISTINCT d) AS df FROM {tokens} GROUP BY 1
                ORDER BY count(*) DESC, term LIMIT 5000) USING (term)
          CROSS JOIN (SELECT {size} AS n))"""


TABLES |= {
    "sim_u": cosine_sql("centred", "u", "i", "c"),
    "sim_raw": cosine_sql("seen", "u", "i", "m"),
    "sim_i": cosine_sql("centred", "i", "u", "c"),
    "near_u": """
        SELECT u, v, s FROM (
          SELECT x.u AS u, y.u AS v, greatest(coalesce(s, 0.0), 0.0) AS s,
                 row_number() OVER (PARTITION BY x.u ORDER BY greatest(coalesce(s, 0.0), 0.0) DESC, y.u) AS rn
          FROM (SELECT DISTINCT u FROM cell) x JOIN (SELECT DISTINCT u FROM cell) y ON x.u <> y.u
          LEFT JOIN sim_u ON a = x.u AND b = y.u)
        WHERE rn <= 20""",
    "score_u": """
        SELECT near_u.u AS u, seen.i AS i, sum(s * m) / sum(s) AS base
        FROM near_u JOIN seen ON seen.u = near_u.v
        WHERE near_u.u IN (SELECT u FROM cell GROUP BY u HAVING sum(m) >= 50)
        GROUP BY 1, 2 HAVING count(*) >= 3 AND sum(s) > 0""",
    "score_i": item_scores_sql("sim_i"),
    "catalog": """
        SELECT p_partkey AS i, p_name AS title,
               p_name || ' ' || p_type || ' ' || p_type || ' ' || p_size || ' ' || p_brand || ' '
                 || (p_size + 1) || ' ' || p_name || ' ' || lower(p_brand) || ' ' || p_size AS body
        FROM part WHERE p_partkey <> 0""",
    "aligned": """
        SELECT i, coalesce(title, 'Content ' || i) AS title, coalesce(body, 'content ' || i) AS body
        FROM (SELECT DISTINCT i FROM cell) LEFT JOIN catalog USING (i)""",
    "tokens_t": tokens_sql("i", "body", "aligned"),
    "weights_t": weights_sql("tokens_t", "(SELECT count(*) FROM aligned)"),
    "sim_t": cosine_sql("weights_t", "d", "term", "x"),
    "score_t": item_scores_sql("sim_t"),
}


def list_tables(scored: str, name: str) -> None:
    """Define the top-ten lists over the scores in ``scored``."""
    TABLES[f"{name}_own"] = f"""
        SELECT s.u, s.i, round(base * {NOVELTY.format('coalesce(m, 0)')}, 9) AS score, coalesce(m, 0) AS own
        FROM {scored} s LEFT JOIN cell USING (u, i)"""
    TABLES[f"{name}_fill"] = f"""
        SELECT u, i, pos, round(pop * {NOVELTY.format('own')}, 9) AS score, own FROM (
          SELECT x.u, p.i, p.pos, p.pop, coalesce(c.m, 0) AS own, n,
                 row_number() OVER (PARTITION BY x.u ORDER BY p.pos) AS k
          FROM (SELECT u.u, count(o.i) AS n FROM (SELECT DISTINCT u FROM cell) u
                LEFT JOIN {name}_own o ON o.u = u.u GROUP BY u.u HAVING count(o.i) < 10) x
          CROSS JOIN popular p
          LEFT JOIN cell c ON c.u = x.u AND c.i = p.i
          WHERE NOT EXISTS (SELECT 1 FROM {name}_own o WHERE o.u = x.u AND o.i = p.i))
        WHERE k <= 30 - n"""
    TABLES[name] = f"""
        SELECT u, i, score, own, rn FROM (
          SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, src, pos) AS rn FROM (
            SELECT u, i, score, own, 0 AS src, i AS pos FROM {name}_own
            UNION ALL SELECT u, i, score, own, 1, pos FROM {name}_fill))
        WHERE rn <= 10"""
    MODEL_NEEDS[f"{name}_own"] = [scored, "cell"]
    MODEL_NEEDS[f"{name}_fill"] = [f"{name}_own", "popular"]
    MODEL_NEEDS[name] = [f"{name}_own", f"{name}_fill"]


MODEL_NEEDS: dict[str, list[str]] = {
    "sim_u": ["centred"],
    "sim_raw": ["seen"],
    "sim_i": ["centred"],
    "near_u": ["cell", "sim_u"],
    "score_u": ["near_u", "seen"],
    "score_i": ["seen", "sim_i"],
    "aligned": ["cell", "catalog"],
    "tokens_t": ["aligned"],
    "weights_t": ["tokens_t", "aligned"],
    "sim_t": ["weights_t"],
    "score_t": ["seen", "sim_t"],
}

list_tables("score_u", "lists_u")
list_tables("score_i", "lists_i")
list_tables("score_t", "lists_t")

NEEDS = {
    **MODEL_NEEDS,
    "category": ["bridge"],
    "cell": ["viewing"],
    "seen": ["cell"],
    "n_users": ["cell"],
    "n_items": ["cell"],
    "popular": ["cell", "n_users"],
    "centred": ["seen"],
}


def _ordered(names: list[str], tables: dict[str, str], needs: dict[str, list[str]]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        for other in needs.get(name, []):
            visit(other)
        if name not in done:
            done.append(name)

    for name in names:
        visit(name)
    return done


def with_tables(names: str, sql: str) -> str:
    """``sql`` with the named tables, and what they rest on, defined before it."""
    ordered = _ordered(names.split(), TABLES, NEEDS)
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in ordered) + "\n" + sql
