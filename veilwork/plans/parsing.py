"""Queries of the record parser."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilwork.operators.parsing import NOTE_TYPES, failed_records, load_valid
from veilwork.sources.tables import table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_records(table(spark, sf_dir, "test_raw"))


def p5_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_valid(table(spark, sf_dir, "test_raw"))


QUERIES = {"p5_found": p5_found, "p5_loaded": p5_loaded}

_FIELD = '(?:"(?:[^"]|"")*"|[^",]*)'
_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*"
_GROUPS = ",".join(['("(?:[^"]|"")*"|[^",]*)'] * 6)
_CELL = """CASE WHEN c{i} LIKE '"%' THEN replace(c{i}[2:-2], '""', '"') ELSE c{i} END"""
_SPLIT = ", ".join(rf"regexp_extract(raw, '(?s)\A{_GROUPS}\z', {i + 1}) AS c{i}" for i in range(6))
_JUDGED = rf"""
q AS (SELECT raw_id, coalesce(raw, '') AS raw FROM test_raw),
s AS (SELECT *, regexp_full_match(raw, '(?s){_FIELD}(?:,{_FIELD})*') AS ok,
        len(regexp_replace(raw, '(?s)"(?:[^"]|"")*"', '', 'g')) - len(replace(regexp_replace(raw, '(?s)"(?:[^"]|"")*"', '', 'g'), ',', '')) AS commas FROM q),
c AS (SELECT *, {_SPLIT} FROM s),
v AS (SELECT raw_id, ok, commas, {", ".join(_CELL.format(i=i) + f" AS f{i}" for i in range(6))} FROM c),
j AS (SELECT *, CASE WHEN NOT ok THEN 'quoting' WHEN commas <> 5 THEN 'column_count'
  WHEN NOT regexp_full_match(f0, '[0-9]+') OR coalesce(try_cast(f0 AS HUGEINT), 9223372036854775808) NOT BETWEEN 1 AND 9223372036854775807
    OR regexp_full_match(f1, '(?s){_SPACE}') OR f3 NOT IN ({", ".join(f"'{t}'" for t in NOTE_TYPES)})
    OR NOT (f4 = '' OR (regexp_full_match(f4, '[0-9]+') AND coalesce(try_cast(f4 AS HUGEINT), 999) <= 120))
    OR NOT regexp_full_match(f5, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}')
    OR try_strptime(f5, '%Y-%m-%dT%H:%M:%S') IS NULL THEN 'bad_value' END AS reason FROM v)"""

ORACLE = {
    "p5_found": f"WITH {_JUDGED} SELECT raw_id, reason FROM j WHERE reason IS NOT NULL",
    "p5_loaded": f"""WITH {_JUDGED} SELECT raw_id, CAST(f0 AS BIGINT) AS id, f1 AS text, f2 AS facility, f3 AS note_type,
  CAST(nullif(f4, '') AS INT) AS age, strptime(f5, '%Y-%m-%dT%H:%M:%S') AS written_at FROM j WHERE reason IS NULL""",
}
