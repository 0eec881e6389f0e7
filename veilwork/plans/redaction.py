"""Queries of the redaction engine over the notes, each with its SQL."""

from __future__ import annotations

from functools import partial, reduce
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.functions import rules as R
from veilwork.functions import spans as S
from veilwork.functions.text import is_blank, strip_space
from veilwork.operators import scoring, stats
from veilwork.operators.engine import RedactConfig, detect, redact
from veilwork.operators.maskers import ListMasker, RuleMasker, spans_of
from veilwork.plans import sql as Q
from veilwork.sources.io import names_of
from veilwork.sources.tables import spread, table

#: Mask dictionaries that are applied together.
MASK_SETS = 50
_TERMS = ("metformin", "apixaban", "insulin glargine", "insulin")


def _notes(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "test").select("id", "text", *columns), "id")


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of all lists."""
    return names_of(table(spark, sf_dir, "known_names"))


def _span_rows(df: DataFrame, spans: str = "spans") -> DataFrame:
    return df.select("id", F.explode(spans).alias("s")).select("id", "s.start", "s.end", "s.label")


def rule_query(rule: R.Rule, spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches of one rule in the stored texts."""
    notes = _notes(spark, sf_dir).where("text IS NOT NULL")
    return _span_rows(notes.select("id", S.rule_spans(F.col("text"), rule, 0).alias("spans")))


def spans_person_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons of whom one token is a known name, in the stored texts."""
    cfg = RedactConfig(maskers=(RuleMasker(rules=(R.PERSON,), tags=()),), normalize=False)
    return _span_rows(detect(_notes(spark, sf_dir), "text", cfg, names=_names(spark, sf_dir), key="id"))


def _rules_on_notes(spark: SparkSession, sf_dir: str, types: tuple[str, ...] = ()) -> DataFrame:
    """Notes with the spans of all rules outside existing tags."""
    notes = _notes(spark, sf_dir).where("text IS NOT NULL")
    return notes.withColumn("spans", spans_of(RuleMasker(normalize=False), F.col("text"), types))


def overlap_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all rules outside existing tags."""
    return _span_rows(_rules_on_notes(spark, sf_dir))


def tag_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = _notes(spark, sf_dir).where("text IS NOT NULL")
    return _span_rows(notes.select("id", S.tag_ranges(F.col("text")).alias("spans"))).drop("label")


def type_filter_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_rows(_rules_on_notes(spark, sf_dir, ("PHONE", "EMAIL", "person")))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans reported by maskers, as one array a note in masker order (bag union); null lists and spans vanish."""
    lists = table(spark, sf_dir, "span_lists").where("id IS NOT NULL AND spans IS NOT NULL")
    each = lists.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("masker", "spans"))).alias("l"))
    flat = F.filter(F.flatten(F.transform("l", lambda x: x["spans"])), lambda s: s.isNotNull() & s["start"].isNotNull() & s["end"].isNotNull())
    return each.select("id", flat.alias("spans"))


def span_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_rows(_listed(spark, sf_dir))


def type_filter_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported spans whose label holds ``per`` or ``date`` in any case."""
    return _span_rows(_listed(spark, sf_dir).select("id", S.of_types_within(F.col("spans"), ("PER", "Date")).alias("spans")))


def merge_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported spans of all maskers, sorted and merged."""
    return _span_rows(_listed(spark, sf_dir).select("id", S.merged(F.col("spans")).alias("spans")))


def upper_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = _rules_on_notes(spark, sf_dir)
    return _span_rows(notes.select("id", S.without_capitals(F.col("spans"), F.col("text")).alias("spans")))


def mask_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with the merged reported spans masked."""
    spans = _listed(spark, sf_dir).select("id", S.merged(F.col("spans")).alias("spans"))
    notes = table(spark, sf_dir, "test").where("text IS NOT NULL").select("id", "text").join(spans, "id")
    return notes.select("id", S.masked(F.col("text"), F.col("spans")).alias("masked"))


def mask_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``mask_listed`` with every stored dictionary of masks; a dictionary without a label leaves it the default.

    The dictionaries are configuration: ``MASK_SETS`` of them at a time stand beside the
    rows, so notes are read once a block and never joined with them on nothing.
    """
    sets = ((r.mask_set, r.masks) for r in table(spark, sf_dir, "custom_masks").select("mask_set", "masks").orderBy("mask_set").toLocalIterator())
    spans = _listed(spark, sf_dir).select("id", S.merged(F.col("spans")).alias("spans"))
    notes = table(spark, sf_dir, "test").where("text IS NOT NULL").select("id", "text").join(spans, "id")
    parts = []
    while block := list(islice(sets, MASK_SETS)):
        rows = notes.select("id", S.masked_by_sets(F.col("text"), F.col("spans"), block).alias("rows"))
        parts.append(rows.select("id", F.explode("rows").alias("r")).select("id", "r.mask_set", "r.masked"))
    empty = notes.select("id", F.lit("").alias("mask_set"), F.lit("").alias("masked")).limit(0)
    return reduce(DataFrame.unionByName, parts, empty) if not parts else reduce(DataFrame.unionByName, parts)


def collapse_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "expected_notes").where("id IS NOT NULL AND text IS NOT NULL")
    return expected.select("id", S.collapsed(F.col("text")).alias("collapsed"))


def redact_two_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default engine: every rule, two passes, detection on the compatibility form; the other columns pass through."""
    return redact(_notes(spark, sf_dir, "note_no", "facility"), "text", RedactConfig())


def redact_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``redact_two_pass``, detecting on the stored characters."""
    return redact(_notes(spark, sf_dir), "text", RedactConfig(normalize=False))


def redact_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons only where a token is a known name."""
    return redact(_notes(spark, sf_dir), "text", RedactConfig(), names=_names(spark, sf_dir), key="id")


def redact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return redact(docs, "text", RedactConfig())


def _counted(spark: SparkSession, sf_dir: str, dry: bool) -> DataFrame:
    return redact(_notes(spark, sf_dir), "text", RedactConfig(dry_run=dry), "spans")


def label_stats(spark: SparkSession, sf_dir: str, dry: bool = False) -> DataFrame:
    return stats.label_counts(_counted(spark, sf_dir, dry))


def total_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.totals(_counted(spark, sf_dir, False))


def context_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(_notes(spark, sf_dir), "text", RedactConfig())
    return stats.contexts(found, "id")


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notes(spark, sf_dir).where("text IS NOT NULL").select("id", S.preview(F.col("text")).alias("preview"))


def names_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names_of(table(spark, sf_dir, "known_names"))


def ner_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plug-in detector beside the rules: terms of a list, labelled DRUG."""
    masker = ListMasker(_TERMS, "DRUG")
    return _span_rows(detect(_notes(spark, sf_dir), "text", RedactConfig(maskers=(masker,))))


def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = _notes(spark, sf_dir).where("text IS NOT NULL")
    return notes.select("id", S.tag_count(F.col("text")).cast("bigint").alias("tags"))


def blank_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notes(spark, sf_dir).select("id", is_blank(F.col("text")).alias("blank"))


def exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "expected_notes").where("id IS NOT NULL AND text IS NOT NULL").select("id", F.col("text").alias("expected"))
    notes = table(spark, sf_dir, "test").where("text IS NOT NULL").select("id", "text")
    same = strip_space(F.col("text")) == strip_space(F.col("expected"))
    return notes.join(expected, "id").select("id", "expected", same.alias("same"))


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One expected text a note: repeated entries count once, and of different ones the first in text order."""
    return table(spark, sf_dir, "expected_notes").where("id IS NOT NULL AND text IS NOT NULL").groupBy("id").agg(F.min("text").alias("text"))


def score_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-pass output scored against the expected notes."""
    expected = _expected(spark, sf_dir)
    sample = table(spark, sf_dir, "test").select("id", "text").join(expected.select("id"), "id", "left_semi")
    actual = redact(sample, "text", RedactConfig())
    return scoring.score(scoring.paired(actual, expected, "id"))


def score_configurations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of two configurations: all rules, and phone numbers only."""
    expected = _expected(spark, sf_dir)
    sample = table(spark, sf_dir, "test").select("id", "text").join(expected.select("id"), "id", "left_semi")
    runs = {"all": RedactConfig(), "phones": RedactConfig(types=("PHONE",))}
    rows = [scoring.score(scoring.paired(redact(sample, "text", cfg), expected, "id")).select(F.lit(name).alias("name"), "*") for name, cfg in runs.items()]
    return reduce(DataFrame.unionByName, rows)


def score_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No expected text at all: every metric is 0."""
    notes = table(spark, sf_dir, "test").select("id", "text")
    return scoring.score(scoring.paired(notes, _expected(spark, sf_dir).limit(0), "id"))


def score_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.rankings(table(spark, sf_dir, "benchmark_result")).select("metric", "rank", "run_id", "name", "value")


def score_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.best(table(spark, sf_dir, "benchmark_result"))


def successful_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = table(spark, sf_dir, "benchmark_result").where("success")
    rate = F.when(F.col("processing_time") > 0, F.col("total_texts") / F.col("processing_time")).otherwise(0.0)
    return ok.select("run_id", "name", rate.alias("texts_per_second"), (F.col("texts_per_second") * F.col("correctness_score") / 100).alias("balanced"))


_BY_RULE = {
    "spans_person": R.PERSON, "spans_date": R.DATE, "spans_ssn": R.SSN, "spans_phone": R.PHONE, "spans_email": R.EMAIL,
    "spans_mrn": R.MRN, "spans_address": R.ADDRESS, "spans_signature": R.SIGNATURE,
}

QUERIES = {name: partial(rule_query, rule) for name, rule in _BY_RULE.items()} | {
    f.__name__: f
    for f in (
        spans_person_known, overlap_exclusion, tag_ranges, type_filter_exact, type_filter_substring, span_union, merge_spans, upper_filter,
        mask_listed, mask_custom, collapse_tags, redact_two_pass, redact_stored, redact_known, redact_documents, label_stats, total_stats,
        context_excerpt, preview, names_set, ner_dictionary, tag_counts, blank_guard, exact_match, score_metrics, score_configurations, score_nothing, score_ranking, score_argmax,
        successful_runs,
    )
}
QUERIES["dry_run_stats"] = partial(label_stats, dry=True)

# ---- SQL -----------------------------------------------------------------------------

_NOTES = "(SELECT id, text FROM test WHERE text IS NOT NULL)"
_NAMES = "SELECT list(n) FROM (SELECT unnest(list_concat(coalesce(names.men, []), coalesce(names.women, []), coalesce(names.last, []))) AS n FROM known_names)"
_TEST = "SELECT id, text FROM test"
_ONE = f"WITH {Q.redaction(_TEST, 1)}"
_ONE_STORED = f"WITH {Q.redaction(_TEST, 1, normalize=False)}"
_TWO = f"WITH {Q.redaction(_TEST)}"
_BLANK = Q.blank("text")
_LISTED = """l AS (SELECT id, s.start AS start, s."end" AS "end", s.label AS label, row_number() OVER (PARTITION BY id ORDER BY masker, r, p) AS ord FROM (
    SELECT id, masker, r, unnest(spans) AS s, generate_subscripts(spans, 1) AS p FROM (
      SELECT id, masker, spans, row_number() OVER (PARTITION BY id, masker ORDER BY spans) AS r FROM span_lists WHERE id IS NOT NULL AND spans IS NOT NULL))
    WHERE s IS NOT NULL AND s.start IS NOT NULL AND s."end" IS NOT NULL)"""
_METRIC = {
    "speed": "texts_per_second", "accuracy": "correctness_score", "f1": "privacy_score", "balanced": "texts_per_second * correctness_score / 100",
}
_LONG = " UNION ALL ".join(f"SELECT run_id, name, '{m}' AS metric, CAST({c} AS DOUBLE) AS value FROM ok" for m, c in _METRIC.items())
_RANKED = f"""ok AS (SELECT DISTINCT * FROM benchmark_result WHERE success), x AS ({_LONG}),
  y AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC NULLS LAST, run_id) AS rank FROM x)"""
_STRIP = lambda t: rf"regexp_replace(regexp_replace({t}, '^{Q.S}+', ''), '{Q.S}+$', '')"
_PAIRS = f"""e AS (SELECT id, min(text) AS text FROM expected_notes WHERE id IS NOT NULL AND text IS NOT NULL GROUP BY id),
  final AS (SELECT x.id, coalesce(t2.text, x.text) AS text FROM test x LEFT JOIN t2 ON t2.id = x.id),
  p AS (SELECT a.text AS actual, e.text AS expected FROM final a JOIN e ON e.id = a.id WHERE a.text IS NOT NULL),
  c AS (SELECT *, (length(actual) - length(replace(actual, '{Q.TAG}', ''))) // {len(Q.TAG)} AS a, (length(expected) - length(replace(expected, '{Q.TAG}', ''))) // {len(Q.TAG)} AS e FROM p),
  s AS (SELECT count(*) AS n, coalesce(sum(e), 0) AS e, coalesce(sum(a), 0) AS a, coalesce(sum(least(a, e)), 0) AS c, count(*) FILTER ({_STRIP('actual')} = {_STRIP('expected')}) AS exact_matches FROM c),
  r AS (SELECT exact_matches, CASE WHEN n = 0 THEN 0 WHEN e > 0 THEN c / e * 100 ELSE 100 END AS accuracy, CASE WHEN a > 0 THEN c / a * 100 ELSE 0 END AS precision, CASE WHEN e > 0 THEN a / e ELSE 0 END AS ratio FROM s)"""

_SCORES = """SELECT accuracy, precision, exact_matches, CASE WHEN accuracy + precision > 0 THEN 2 * accuracy * precision / (accuracy + precision) ELSE 0 END AS f1,
  ratio AS over_redaction_ratio, greatest(ratio - 1, 0) * 100 AS over_redaction_pct FROM r"""

ORACLE = {name: f'SELECT id, start, "end", label FROM ({Q.spans(_NOTES, rule.id)})' for name, rule in _BY_RULE.items()} | {
    "spans_person_known": f'SELECT id, start, "end", label FROM ({Q.spans(_NOTES, "R1", _NAMES)})',
    "overlap_exclusion": f"""WITH t0 AS (SELECT id, text FROM test WHERE text IS NOT NULL), s AS ({" UNION ALL ".join(Q.spans("t0", r) for r in Q.RULES)}), k AS ({Q.tag_ranges("t0")})
      SELECT id, start, "end", label FROM s WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.id = s.id AND s.start < k.a + {len(Q.TAG)} AND s."end" > k.a)""",
    "tag_ranges": f'SELECT id, a AS start, a + {len(Q.TAG)} AS "end" FROM ({Q.tag_ranges(_NOTES)})',
    "type_filter_exact": f"""WITH t0 AS (SELECT id, text FROM test WHERE text IS NOT NULL), s AS ({Q.spans("t0", "R4")} UNION ALL {Q.spans("t0", "R5")}), k AS ({Q.tag_ranges("t0")})
      SELECT id, start, "end", label FROM s WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.id = s.id AND s.start < k.a + {len(Q.TAG)} AND s."end" > k.a)""",
    "type_filter_substring": f"""WITH {_LISTED} SELECT id, start, "end", label FROM l WHERE contains(lower(label), 'per') OR contains(lower(label), 'date')""",
    "span_union": f'WITH {_LISTED} SELECT id, start, "end", label FROM l',
    "merge_spans": f"WITH {_LISTED} {Q.merge('l')}",
    "upper_filter": f"""{_ONE_STORED.replace("NOT " + _BLANK, "true")} SELECT id, start, "end", label FROM f1""",
    "mask_listed": f"WITH {_LISTED}, g AS ({Q.merge('l')}), m AS ({Q.mask(_NOTES, 'g')}) SELECT t.id, coalesce(m.masked, t.text) AS masked FROM {_NOTES} t LEFT JOIN m ON m.id = t.id WHERE t.id IN (SELECT id FROM span_lists WHERE spans IS NOT NULL)",
    "mask_custom": f"""WITH {_LISTED}, g AS ({Q.merge("l")}), c AS (SELECT mask_set, masks FROM custom_masks),
      x AS (SELECT g.*, c.mask_set, coalesce(c.masks[g.label], '{Q.TAG}') AS mask, coalesce(lag(g."end") OVER (PARTITION BY g.id, c.mask_set ORDER BY g.start), 0) AS before FROM g, c)
      SELECT * FROM (SELECT t.id, c.mask_set, t.text AS masked FROM {_NOTES} t, c WHERE t.id IN (SELECT id FROM span_lists WHERE spans IS NOT NULL) AND t.id NOT IN (SELECT id FROM g)) UNION ALL
      SELECT x.id, x.mask_set, string_agg(substr(t.text, x.before + 1, x.start - x.before) || x.mask, '' ORDER BY x.start) || substr(any_value(t.text), max(x."end") + 1) AS masked
      FROM x JOIN {_NOTES} t ON t.id = x.id GROUP BY x.id, x.mask_set""",
    "collapse_tags": f"SELECT id, {Q.collapse('text')} AS collapsed FROM expected_notes WHERE id IS NOT NULL AND text IS NOT NULL",
    "redact_two_pass": f"{_TWO} SELECT x.id, coalesce(t2.text, x.text) AS text, x.note_no, x.facility FROM test x LEFT JOIN t2 ON t2.id = x.id",
    "redact_stored": f"WITH {Q.redaction(_TEST, normalize=False)} SELECT x.id, coalesce(t2.text, x.text) AS text FROM test x LEFT JOIN t2 ON t2.id = x.id",
    "redact_known": f"WITH {Q.redaction(_TEST, names=_NAMES)} SELECT x.id, coalesce(t2.text, x.text) AS text FROM test x LEFT JOIN t2 ON t2.id = x.id",
    "redact_documents": f"WITH {Q.redaction('SELECT doc_id AS id, text FROM documents')} SELECT x.doc_id, coalesce(t2.text, x.text) AS text FROM documents x LEFT JOIN t2 ON t2.id = x.doc_id",
    "label_stats": f"{_TWO} SELECT label, count(*) AS cnt FROM (SELECT label FROM g1 UNION ALL SELECT label FROM g2) GROUP BY label",
    "dry_run_stats": f"WITH {Q.redaction(_TEST, dry=True)} SELECT label, count(*) AS cnt FROM (SELECT label FROM g1 UNION ALL SELECT label FROM g2) GROUP BY label",
    "total_stats": f"{_TWO} SELECT (SELECT count(*) FROM t0) AS total_processed, (SELECT count(*) FROM g1) + (SELECT count(*) FROM g2) AS total_entities",
    "context_excerpt": f"""{_ONE} SELECT g.id, CAST(row_number() OVER (PARTITION BY g.id ORDER BY g.start) AS INT) AS nr, g.label, substr(t.text, g.start + 1, g."end" - g.start) AS entity,
      substr(t.text, greatest(g.start - 30, 0) + 1, g.start - greatest(g.start - 30, 0)) AS before, substr(t.text, g."end" + 1, 30) AS after, g.start, g."end" FROM g1 g JOIN t0 t ON t.id = g.id""",
    "preview": "SELECT id, substr(text, 1, 100) || CASE WHEN length(text) > 100 THEN '...' ELSE '' END AS preview FROM test WHERE text IS NOT NULL",
    "names_set": "SELECT DISTINCT name FROM (SELECT unnest(list_concat(coalesce(names.men, []), coalesce(names.women, []), coalesce(names.last, []))) AS name FROM known_names) WHERE name IS NOT NULL",
    "ner_dictionary": f"""WITH {Q.redaction(_TEST, 1, ("L1",), normalize=False)} SELECT id, start, "end", label FROM g1""",
    "tag_counts": f"SELECT id, (length(text) - length(replace(text, '{Q.TAG}', ''))) // {len(Q.TAG)} AS tags FROM test WHERE text IS NOT NULL",
    "blank_guard": f"SELECT id, text IS NULL OR {_BLANK} AS blank FROM test",
    "exact_match": f"SELECT t.id, e.text AS expected, {_STRIP('t.text')} = {_STRIP('e.text')} AS same FROM test t JOIN expected_notes e ON e.id = t.id WHERE t.text IS NOT NULL AND e.text IS NOT NULL",
    "score_metrics": f"{_TWO}, {_PAIRS} {_SCORES}",
    "score_configurations": f"SELECT 'all' AS name, * FROM ({_TWO}, {_PAIRS} {_SCORES}) UNION ALL SELECT 'phones' AS name, * FROM (WITH {Q.redaction(_TEST, rules=('R4',))}, {_PAIRS} {_SCORES})",
    "score_nothing": "SELECT CAST(0 AS DOUBLE) AS accuracy, CAST(0 AS DOUBLE) AS precision, CAST(0 AS BIGINT) AS exact_matches, CAST(0 AS DOUBLE) AS f1, CAST(0 AS DOUBLE) AS over_redaction_ratio, CAST(0 AS DOUBLE) AS over_redaction_pct",
    "score_ranking": f"WITH {_RANKED} SELECT metric, rank, run_id, name, value FROM y",
    "score_argmax": f"WITH {_RANKED} SELECT metric, name, value FROM y WHERE rank = 1",
    "successful_runs": "SELECT run_id, name, CASE WHEN processing_time > 0 THEN total_texts / processing_time ELSE 0 END AS texts_per_second, texts_per_second * correctness_score / 100 AS balanced FROM benchmark_result WHERE success",
}
