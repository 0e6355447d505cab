"""The registered form of the Merkle manifest: every document, some of them tampered with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm import merkle
from cinelake.llm.common import remainder

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """Digests of each document and the root its proof gives, where every third document
    by crc32 of its id comes back with the letters A-Z of its text in lower case. A row
    without id is not tampered with."""
    lowered = [F.translate("text", _UPPER, _LOWER) if f == "text" else F.col(f) for f in merkle.FIELDS]
    chosen = F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 3) == 0)
    found = merkle.manifest(docs, carry={"tampered": F.when(chosen, merkle.digest(*lowered))})
    root = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_sql(levels: int = 7, group_levels: int = 3) -> str:
    """The same in SQL, for at most 8^levels documents of a language and 8^group_levels languages."""

    def sides(h: str) -> str:
        run = "OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN"
        return (
            f"coalesce(string_agg({h}, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg({h}, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"
        )

    def tree(name: str, count: int) -> str:
        steps = []
        for k in range(count):
            steps.append(f"{name}s{k} AS (SELECT g, pos, h, n, {sides('h')} FROM {name}{k})")
            steps.append(
                f"{name}{k + 1} AS (SELECT g, pos // 8 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) "
                f"ELSE any_value(h) END AS h, (any_value(n) + 7) // 8 AS n FROM {name}{k} GROUP BY g, pos // 8)"
            )
        return ",\n".join(steps)

    def field(name: str) -> str:
        return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(f) for f in merkle.FIELDS[:-1])} || {field(text)})"

    def climbed(name: str, source: str, count: int, start: str) -> str:
        """Fold and proof of every leaf through the levels of a tree."""
        out, last = [], source
        for k in range(count):
            here = f"{name}{k}"
            out.append(
                f"{here} AS (SELECT t.* EXCLUDE (node, proof), CASE WHEN s.n > 1 THEN sha256(s.l || t.node || s.r) ELSE t.node END AS node, "
                f"CASE WHEN s.n > 1 THEN t.proof || s.l || s.r ELSE t.proof END AS proof "
                f"FROM {last} t JOIN {start}s{k} s ON s.g IS NOT DISTINCT FROM t.{'lang_key' if start == 'a' else 'all_key'} "
                f"AND s.pos = t.{'rank' if start == 'a' else 'place'} // {8**k})"
            )
            last = here
        return ",\n".join(out)

    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    return f"""
WITH crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) r(i)
), leaves AS (
  SELECT doc_id, lang AS lang_key, 0 AS all_key, {leaf('text')} AS leaf,
    CASE WHEN xor(list_reduce(list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 3 = 0 THEN {leaf(lowered)} END AS tampered
  FROM documents, crc_table
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang_key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang_key) AS n
  FROM leaves
), a0 AS (SELECT lang_key AS g, rank AS pos, leaf AS h, n FROM ranked),
{tree('a', levels)},
b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, h, count(*) OVER () AS n FROM a{levels}),
places AS (SELECT g AS lang_key, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS place FROM a{levels}),
{tree('b', group_levels)},
climb AS (
  SELECT r.*, p.subroot, p.place, coalesce(tampered, leaf) AS node, '' AS proof
  FROM ranked r JOIN places p ON p.lang_key IS NOT DISTINCT FROM r.lang_key
),
{climbed('x', 'climb', levels, 'a')},
{climbed('y', f'x{levels - 1}', group_levels, 'b')}
SELECT doc_id, leaf, subroot, (SELECT h FROM b{group_levels}) AS root, sha256(proof) AS proof_sha256, node AS folded_root,
  node = (SELECT h FROM b{group_levels}) AS verified
FROM y{group_levels - 1}
"""
