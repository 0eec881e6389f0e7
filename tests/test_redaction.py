import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veilwork.functions import scan
from veilwork.functions import spans as S
from veilwork.functions.rules import ADDRESS, RULES, SIGNATURE
from veilwork.operators import scoring, stats
from veilwork.operators.engine import RedactConfig, detect, redact, redact_text, redact_texts
from veilwork.operators.maskers import ListMasker, RuleMasker
from veilwork.sources.io import names_of, read_csv, read_masks, read_names, report, write_csv

CASES = [
    ("Patient John Smith, phone 555-123-4567.", "[REDACTED], phone [REDACTED]."),
    ("Call 555-123-4567 for details.", "Call [REDACTED] for details."),
    ("Email is test.person@example.com.", "Email is test.person@example.com."),
    ("MRN 1234567", "MRN 1234567"),
    ("MRN: 1234567", "MRN: [REDACTED]"),
    ("on 2024-03-10", "on 202[REDACTED]"),
    ("on 2020-03-10", "on 2020-03-10"),
    ("mail a@b.com now", "mail [REDACTED] now"),
    ("mail a@b.com.", "mail a@b.com."),
    ("JOHN@EXAMPLE.COM", "JOHN@EXAMPLE.COM"),
    ("5551234567", "[REDACTED]"),
    ("Dr. Chen DWA", "Dr. [REDACTED] DWA"),
    ("DWR Chen DWA", "DWR [REDACTED] DWA"),
    ("ssn 123-45-6789 here", "ssn [REDACTED] here"),
    ("123 Main St, Springfield, IL 62704", "[REDACTED]"),
    ("[REDACTED]  \n[REDACTED] was seen 1/2/2024", "[REDACTED] was seen [REDACTED]"),
    ("é😀 call 555-123-4567 é", "é😀 call [REDACTED] é"),
    (None, None),
    ("", ""),
    ("   ", "   "),
    ("   ", "   "),
]


def test_cases_from_the_blueprint(spark):
    assert redact_texts(spark, [c[0] for c in CASES]) == [c[1] for c in CASES]


def test_empty_list_and_empty_table(spark):
    assert redact_texts(spark, []) == []
    empty = spark.createDataFrame([], "id int, text string")
    assert redact(empty).collect() == []
    assert stats.label_counts(redact(empty, spans_to="spans")).collect() == []
    total = stats.totals(redact(empty, spans_to="spans")).first()
    assert (total.total_processed, total.total_entities) == (0, 0)


def test_missing_column(spark):
    with pytest.raises(ValueError):
        redact(spark.createDataFrame([(1,)], "id int"), "text")


def test_other_columns_pass_through_even_with_odd_names(spark):
    df = spark.createDataFrame([("Call 555-123-4567", "k", 3)], "text string, `a.b` string, spans int")
    row = redact(df, "text").first()
    assert (row["text"], row["a.b"], row["spans"]) == ("Call [REDACTED]", "k", 3)


def test_known_names_and_types(spark):
    cfg = RedactConfig(maskers=(RuleMasker(("John", "Doe", "Smith")),))
    assert redact_text(spark, "A patient named John Doe saw Mary Major.", cfg) == "A patient named [REDACTED] saw Mary Major."
    cfg = RedactConfig(types=("PHONE",))
    assert redact_text(spark, "John Doe 555-123-4567", cfg) == "John Doe [REDACTED]"
    assert redact_text(spark, "John Doe 555-123-4567", RedactConfig(types=("phone",))) == "John Doe 555-123-4567"


def test_custom_masks_and_empty_mask(spark):
    text = "John Doe 555-123-4567"
    assert redact_text(spark, text, RedactConfig(custom_masks={"PERSON": "<P>"})) == "<P> [REDACTED]"
    assert redact_text(spark, text, RedactConfig(default_mask="")) == " "
    assert redact_text(spark, text, RedactConfig(default_mask="$1\\")) == "$1\\"


def test_dry_run_counts_every_pass(spark):
    df = spark.createDataFrame([("John Doe 555-123-4567",), (None,), (" ",)], "text string")
    out = redact(df, "text", RedactConfig(dry_run=True), "spans")
    assert out.first().text == "John Doe 555-123-4567"
    assert {r.label: r.cnt for r in stats.label_counts(out).collect()} == {"PERSON": 2, "PHONE": 2}
    total = stats.totals(out).first()
    assert (total.total_processed, total.total_entities) == (1, 4)


def test_compatibility_form(spark):
    text = "½ ok, Tel ５５５-123-4567…"
    assert redact_text(spark, text) == "½ ok, Tel [REDACTED]…"
    assert redact_text(spark, text, RedactConfig(normalize=False)) != redact_text(spark, text, RedactConfig(nfkc_compat=True))
    assert redact_text(spark, None, RedactConfig(null_mode="nan")) == "nan"


def _merge(spark, spans):
    rows = [(1, spans)]
    df = spark.createDataFrame(rows, f"id int, spans array<{S.SPAN}>")
    return [(s.start, s.end, s.label) for s in df.select(S.merged(F.col("spans")).alias("m")).first().m]


def test_merge(spark):
    assert _merge(spark, [(10, 20, "PERSON"), (15, 25, "PERSON"), (30, 40, "DATE")]) == [(10, 25, "PERSON"), (30, 40, "DATE")]
    assert _merge(spark, []) == []
    assert _merge(spark, [(0, 5, "A"), (5, 9, "B")]) == [(0, 5, "A"), (5, 9, "B")]
    assert _merge(spark, [(8, 9, "C"), (0, 9, "A"), (0, 3, "B"), (2, 12, "D")]) == [(0, 12, "A")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 8)), max_size=7), min_size=1, max_size=20))
def test_merge_invariants(spark, groups):
    rows = [(n, [(a, a + w, "L") for a, w in g]) for n, g in enumerate(groups)]
    df = spark.createDataFrame(rows, f"id int, spans array<{S.SPAN}>")
    for n, m in df.select("id", S.merged(F.col("spans"))).collect():
        bounds = [(s.start, s.end) for s in m]
        assert bounds == sorted(bounds)
        assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
        covered = {p for _, _, _, _ in [] for p in ()} | {p for a, w in groups[n] for p in range(a, a + w)}
        assert {p for a, b in bounds for p in range(a, b)} == covered


def test_mask_skips_overlaps(spark):
    df = spark.createDataFrame([("John Smith lives in New York.", [(0, 10, "P"), (5, 12, "P"), (20, 28, "L")])], f"t string, s array<{S.SPAN}>")
    assert df.select(S.masked(F.col("t"), F.col("s"))).first()[0] == "[REDACTED] lives in [REDACTED]."


def test_collapse_is_idempotent(spark):
    text = "[REDACTED] [REDACTED]\n\t[REDACTED][REDACTED] was seen on [REDACTED]."
    df = spark.createDataFrame([(text,), ("[REDACTED]" * 5000,)], "t string")
    once = [r[0] for r in df.select(S.collapsed(F.col("t"))).collect()]
    assert once == ["[REDACTED] was seen on [REDACTED].", "[REDACTED]"]


def test_address_rule_against_the_nested_form():
    import re

    nested = re.compile(
        r"\d{1,5}\s+(?:[A-Za-z0-9]+\s?){2,8}(?:,\s?)?[A-Za-z]+(?:[ -][A-Za-z]+)*(?:,\s?)?[A-Z]{2}(?:,?\s?\d{5})?"
    )

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet="aB1C ,-\n  ", max_size=16).map(lambda t: "12 " + t))
    def same(text):
        assert [m.span() for m in nested.finditer(text)] == scan.rule_matches(text, ADDRESS)

    same()


def test_very_long_texts(spark):
    rows = ["a" * 200_000, "12 " + "word " * 20_000 + "NY", "x@" * 20_000, "9" * 50_000, "\n" * 50_000, "Ab " * 20_000]
    out = redact_texts(spark, rows, RedactConfig(num_passes=1))
    assert out[0] == rows[0] and out[4] == rows[4] and out[3] == rows[3].replace("9" * 50_000, "[REDACTED]")


def test_rules_are_complete():
    assert [r.id for r in RULES] == [f"R{i}" for i in range(1, 9)]
    assert ADDRESS.label == "ADDRESS" and SIGNATURE.group == 1


def test_type_filters_and_capitals(spark):
    df = spark.createDataFrame([("AB cd", [(0, 2, "MRN"), (0, 2, "Person"), (3, 5, "MRN")])], f"t string, s array<{S.SPAN}>")
    kept = df.select(S.without_capitals(F.col("s"), F.col("t")).alias("k")).first().k
    assert [(s.start, s.label) for s in kept] == [(0, "Person"), (3, "MRN")]
    within = df.select(S.of_types_within(F.col("s"), ("PERS",)).alias("k")).first().k
    assert [s.label for s in within] == ["Person"]


def test_list_masker_and_contexts(spark):
    df = spark.createDataFrame([(1, "took insulin glargine twice")], "id int, text string")
    found = detect(df, "text", RedactConfig(maskers=(ListMasker(("insulin", "insulin glargine", None, " "), "DRUG"),)))
    row = stats.contexts(found, "id").first()
    assert (row.nr, row.label, row.entity, row.before, row.after) == (1, "DRUG", "insulin glargine", "took ", " twice")


def test_failing_masker_fails_the_job(spark):
    from veilwork.operators.maskers import ModelMasker

    cfg = RedactConfig(maskers=(ModelMasker("no-such-model"),), normalize=False)
    with pytest.raises(Exception):
        redact_text(spark, "John Doe", cfg)
    cfg = RedactConfig(maskers=(ModelMasker("no-such-model", on_error="skip"),), normalize=False)
    assert redact_text(spark, "John Doe", cfg) == "John Doe"


def test_scores(spark):
    pairs = [("[REDACTED] a", "[REDACTED] a "), ("[REDACTED] [REDACTED]", "[REDACTED]"), ("x", "[REDACTED]")]
    row = scoring.score(spark.createDataFrame(pairs, "actual string, expected string")).first()
    assert row.exact_matches == 1 and row.accuracy == pytest.approx(200 / 3) and row.precision == pytest.approx(200 / 3)
    assert row.over_redaction_ratio == 1.0 and row.over_redaction_pct == 0.0
    none = scoring.score(spark.createDataFrame([], "actual string, expected string")).first()
    assert (none.accuracy, none.precision, none.f1, none.exact_matches) == (0.0, 0.0, 0.0, 0)


def test_ranking_ties_and_nulls(spark):
    rows = [(1, "a", True, 5.0, 50.0, 1.0), (2, "b", True, 5.0, None, 2.0), (3, "c", False, 9.0, 9.0, 9.0), (1, "a", True, 5.0, 50.0, 1.0)]
    df = spark.createDataFrame(rows, "run_id long, name string, success boolean, texts_per_second double, correctness_score double, privacy_score double")
    best = {r.metric: r.name for r in scoring.best(df).collect()}
    assert best == {"speed": "a", "accuracy": "a", "f1": "b", "balanced": "a"}
    ranks = [(r.metric, r["rank"], r.name) for r in scoring.rankings(df).collect()]
    assert ("speed", 1, "a") in ranks and ("speed", 2, "b") in ranks and len(ranks) == 8


def test_files(spark, tmp_path):
    names = tmp_path / "names.json"
    names.write_text(json.dumps({"men": ["John"], "last": ["Smith", "Doe"]}))
    assert read_names(str(names)) == {"John", "Smith", "Doe"} and read_names(str(tmp_path / "none.json")) == set()
    assert read_masks('{"A": "b"}') == {"A": "b"} and read_masks("{broken") == {} and read_masks("/nowhere") == {} and read_masks(None) == {}
    path = tmp_path / "in.csv"
    path.write_text('id,text\n007,"He said ""hi""\ncall 555-123-4567"\n2,\n')
    df = read_csv(spark, str(path), "text")
    write_csv(redact(df, "text"), str(tmp_path / "out"), single_file=True)
    back = read_csv(spark, str(tmp_path / "out")).orderBy("id").collect()
    assert [(r.id, r.text) for r in back] == [("007", 'He said "hi"\ncall [REDACTED]'), ("2", None)]
    with pytest.raises(ValueError):
        read_csv(spark, str(path), "nope")
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "no.csv"))
    assert read_csv(spark, str(tmp_path / "no.csv"), optional=True) is None
    lists = spark.createDataFrame([(("A", ["John", None], None, ["Doe"]),), (None,)], "names struct<list:string,men:array<string>,women:array<string>,last:array<string>>")
    assert {r.name for r in names_of(lists).collect()} == {"John", "Doe"}
    assert "Best by speed: a" in report([{"name": "a", "success": True}], [{"metric": "speed", "rank": 1, "name": "a", "value": 1.0}])


def test_command_line(spark, tmp_path, capsys):
    from veilwork.cli import main

    out = tmp_path / "o.txt"
    rules = ["--maskers", "regex"]
    assert main(["--text", "Call 555-123-4567", "--output_text_file", str(out), "--show_stats", "-v", "--regex_debug", *rules], spark) == 0
    said = capsys.readouterr().out
    assert 'Masked: "Call [REDACTED]"' in said and "PHONE: 1" in said and out.read_text() == "Call [REDACTED]"
    assert "PHONE: '555-123-4567' at 5-17" in said and "1. PHONE at 5-17: ...Call [555-123-4567]..." in said
    rows = tmp_path / "in.csv"
    rows.write_text("id,note\n" + "".join(f'{n},"Call 555-123-4567 and John Doe {n}"\n' for n in range(150)))
    assert main(["--input_csv", str(rows), "--column_name", "note", "--output_csv", str(tmp_path / "csv"), "--n_jobs", "2", "--chunk_size", "1", "-v", "--entity_types", "PHONE", *rules], spark) == 0
    assert capsys.readouterr().out.count("PHONE at") == 150
    assert {r.note for r in read_csv(spark, str(tmp_path / "csv")).collect()} == {f"Call [REDACTED] and John Doe {n}" for n in range(150)}
    assert main(["--test_device"], spark) == 0 and "device: cpu" in capsys.readouterr().out
    with pytest.raises(SystemExit, match="--maskers regex"):
        main(["--text", "x"], spark)
    with pytest.raises(SystemExit):
        main(["--input_csv", "x.csv"], spark)


def test_stream(spark, tmp_path):
    from veilwork.streaming.redact import redact_stream, write_parquet_stream

    src = str(tmp_path / "src")
    spark.createDataFrame([(1, "Call 555-123-4567"), (2, None)], "id int, text string").write.parquet(src)
    stream = spark.readStream.schema("id int, text string").parquet(src)
    write_parquet_stream(redact_stream(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = {r.id: r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: "Call [REDACTED]", 2: None}


def test_plan_has_no_shuffle(spark):
    df = spark.range(10, numPartitions=1).selectExpr("id", "'x' AS text")
    plan = redact(df, "text", RedactConfig())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def _python_steps(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")


def test_every_text_is_redacted_once(spark):
    df = spark.range(10).selectExpr("id", "'John Doe' AS text")
    out = redact(df, "text", RedactConfig(), "spans")
    pairs = scoring.paired(out, df, "id")
    for plan in (out, stats.label_counts(out), stats.totals(out), scoring.score(pairs)):
        assert _python_steps(plan) == 1, plan._jdf.queryExecution().optimizedPlan().toString()
    assert _python_steps(stats.contexts(detect(df), "id")) == 2  # one more for the excerpts


def test_many_spans_in_one_text_take_linear_time(spark):
    import time

    df = spark.createDataFrame([(n, "555-555-0142, John Doe 1/2/2024; " * n) for n in (1, 16_000)], "id int, text string")
    redact(df.where("id = 1")).collect()
    began = time.perf_counter()
    long = redact(df, "text", RedactConfig(), "spans").where("id > 1").first()
    assert time.perf_counter() - began < 6
    assert len(long.spans) == 48_000 and long.text == "[REDACTED], [REDACTED]; " * 16_000


def test_masks_of_earlier_passes_are_protected(spark):
    text = "Seen by John Doe today. Call 555-555-0142 or John Doe"
    for mask in ("<Removed Name>", "Removed Name", "Dr Removed Name"):
        out = redact_text(spark, text, RedactConfig(default_mask=mask, num_passes=4))
        assert out == f"Seen by {mask} today. Call {mask} or {mask}"
        own = redact_text(spark, text, RedactConfig(custom_masks={"PERSON": mask}, num_passes=3))
        assert own == f"Seen by {mask} today. Call [REDACTED] or {mask}"
    assert redact_text(spark, text, RedactConfig(default_mask="<Removed Name>", protect_masks=False)) != redact_text(spark, text, RedactConfig(default_mask="<Removed Name>"))
    # What only looks like a mask in the given text is no mask.
    assert redact_text(spark, "Removed Name came", RedactConfig(default_mask="Removed Name")) == "Removed Name came"
    assert redact_text(spark, "John Doe came", RedactConfig(default_mask="John")) == "John came"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<M>", " ", "\n", "ab", "X", "cd "]), max_size=14), st.lists(st.integers(0, 20), max_size=6))
def test_places_move_with_masks(parts, cuts):
    text = "".join(parts)
    bounds = sorted({c for c in cuts if c <= len(text)})
    spans = [(a, b, "L") for a, b in zip(bounds[::2], bounds[1::2]) if a < b]
    earlier = [r for r in scan.occurrences(text, ("X",)) if not any(a < r[1] and b > r[0] for a, b, _ in spans)]
    out, places = scan.spliced(text, spans, "<M>", {}, earlier)
    assert [out[a:b] for a, b in places] == [x for _, x in sorted([(a, "<M>") for a, _, _ in spans] + [(a, "X") for a, _ in earlier])]
    short, moved = scan.collapsed(out, "<M>", places)
    assert {short[a:b] for a, b in moved} <= {"<M>", "X"} and moved == sorted(moved)
    import re

    assert short == re.sub(r"<M>(\s*<M>)+", "<M>", out)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB1 ½ﬁ…é\u0301ＡＢ5　x\u200b각\u1100\u1161"), max_size=20))
def test_compatibility_form_maps_back(text):
    import unicodedata

    form = scan.compatibility_form(text)
    if form is None:
        assert unicodedata.is_normalized("NFKC", text)
        return
    norm, starts, ends = form
    assert norm == unicodedata.normalize("NFKC", text) and len(starts) == len(ends) == len(norm)
    assert all(a < b for a, b in zip(starts, ends)) and starts == sorted(starts) and ends == sorted(ends)
    assert all(unicodedata.normalize("NFKC", text[starts[k] : ends[k]]).find(c) >= 0 for k, c in enumerate(norm))


def test_names_as_a_table_beyond_the_list(spark, monkeypatch):
    from veilwork.operators import engine

    rows = [(1, "Seen by John Doe and Mary Major"), (2, "Ｊｏｈｎ Ｄｏｅ came"), (3, None), (4, ""), (5, "Dr. Chen DWA"), (None, "John Doe"), (6, "Doe " * 3000)]
    df = spark.createDataFrame([(*r, "n") for r in rows], "id int, text string, name string")
    names = spark.range(200_000).selectExpr("concat('Q', id) AS name").unionByName(spark.createDataFrame([("John",), ("Chen",), (None,), ("John",)], "name string"))
    want = sorted(map(str, redact(df, "text", RedactConfig(maskers=(RuleMasker(("John", "Chen")),))).collect()))
    assert sorted(map(str, redact(df, "text", names=names, key="id").collect())) == want
    monkeypatch.setattr(engine, "NAMES_IN_MEMORY", 1000)
    got = [r for r in redact(df, "text", names=names, key="id").collect() if r.id is not None]
    assert sorted(map(str, got)) == [w for w in want if "id=None" not in w]
    with pytest.raises(ValueError):
        redact(df, "text", names=names)
    assert redact(df, "text", names=names.limit(0), key="id").where("id = 1").first().text == "Seen by [REDACTED] and [REDACTED]"


def test_lenient_mail_addresses(spark):
    text = "mail a@b.com. Or A@B.COM, c@d.com.x"
    assert redact_text(spark, text) == text
    assert redact_text(spark, text, RedactConfig(strict_email=False)) == "mail [REDACTED]. Or [REDACTED], c@d.com.x"


def test_sized_join(spark, monkeypatch):
    from veilwork.functions import join

    left = spark.createDataFrame([(n, "hot" if n % 3 else f"k{n}") for n in range(60)], "n int, k string")
    right = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, v int")
    want = sorted(tuple(r) for r in join.sized_join(left, right, ["k"]).collect())
    monkeypatch.setattr(join, "BROADCAST_ROWS", 0)
    assert sorted(tuple(r) for r in join.sized_join(left, right, ["k"]).collect()) == want
    assert join.sized_join(left, right, ["k"], "left_semi").count() == len(want) == 41


def test_compare(spark, tmp_path):
    from veilwork.operators.benchmark import compare
    from veilwork.operators.maskers import ModelMasker

    notes = spark.createDataFrame([(1, "Call 555-123-4567"), (2, "John Doe"), (3, None)], "id int, text string")
    expected = spark.createDataFrame([(1, "Call [REDACTED]"), (2, "[REDACTED]")], "id int, text string")
    configs = {"All Rules": RedactConfig(), "Phones": RedactConfig(types=("PHONE",)), "Model": RedactConfig(maskers=(ModelMasker("none"),))}
    results, text = compare(spark, notes, expected, configs, str(tmp_path))
    rows = {r.name: r for r in results.collect()}
    assert rows["All Rules"].exact_matches == 2 and rows["Phones"].correctness_score == 50.0 and not rows["Model"].success
    assert "Best by accuracy: All Rules" in text and "| Model | failed" in text


def test_model_masker_sees_whole_texts(monkeypatch):
    import re

    from veilwork.operators import maskers

    def model(texts, batch_size):
        assert max(map(len, texts)) <= 10_000
        return [[{"start": m.start(), "end": m.end(), "entity_group": "PER"} for m in re.finditer("Smith Doe|José", t)] for t in texts]

    monkeypatch.setattr(maskers.ModelMasker, "_load", lambda self: model)
    long = "and so on " * 998 + "Smith Doe " * 5 + "x" * 25_000 + " José" + " é" * 9_000 + " Smith Doe"
    whole = lambda t: [(m.start(), m.end(), "PER") for m in re.finditer("Smith Doe|José", t)]
    masker = maskers.ModelMasker("m", backend="transformers")
    assert masker.detect([long, "", "Smith Doe"]) == [whole(long), [], whole("Smith Doe")]
    assert maskers.ModelMasker("m", backend="transformers", max_chars=10_000).detect([long]) == [whole(long[:10_000])]
    assert masker.detect(["Smith Doe José"], ("per",))[0] and masker.detect(["Smith Doe José"], ("loc",)) == [[]]


def test_devices(monkeypatch):
    from veilwork.operators import maskers

    assert [maskers.pipeline_device(d) for d in ("cpu", "mps", "cuda", "cuda:2", "gpu", "1", 3, -1, "odd")] == [-1, "mps", 0, 2, 0, 1, 3, -1, -1]
    monkeypatch.setattr(maskers, "best_device", lambda: "cuda:1")
    assert maskers.pipeline_device(None) == maskers.pipeline_device("auto") == 1


def test_models_through_stub_packages(spark, monkeypatch):
    """The two call shapes of the model packages, with device fallback and part fallback."""
    import re
    import sys
    import types

    from veilwork.operators import maskers

    calls = []

    def pipeline(task, model, tokenizer, aggregation_strategy, stride, batch_size, device):
        calls.append(("pipeline", task, device, aggregation_strategy, stride))
        if device != -1:
            raise RuntimeError("no such device")
        return lambda texts, batch_size: [[{"start": m.start(), "end": m.end(), "entity_group": "PER"} for m in re.finditer("Zoë", t)] for t in texts]

    loader = types.SimpleNamespace(from_pretrained=lambda name, **o: calls.append((name, o)) or name)
    monkeypatch.setitem(sys.modules, "transformers", types.SimpleNamespace(pipeline=pipeline, AutoTokenizer=loader, AutoModelForTokenClassification=loader))
    masker = maskers.ModelMasker("m1", "transformers", device="cuda:3", cache_dir="/c")
    assert masker.detect(["Zoë x", "y Zoë"]) == [[(0, 3, "PER")], [(2, 5, "PER")]]
    assert ("m1", {"cache_dir": "/c", "use_fast": True, "model_max_length": 512}) in calls
    assert [c[2] for c in calls if c[0] == "pipeline"] == [3, -1]

    class Doc:
        ents = [types.SimpleNamespace(start_char=0, end_char=3, label_="PERSON")]

    def load(name, disable):
        calls.append((name, tuple(disable)))
        if "attribute_ruler" in disable:
            raise ValueError("no such part")
        return types.SimpleNamespace(pipe=lambda texts, batch_size: [Doc() for _ in texts])

    monkeypatch.setitem(sys.modules, "spacy", types.SimpleNamespace(load=load, require_cpu=lambda: calls.append("cpu"), prefer_gpu=lambda: calls.append("gpu")))
    assert maskers.ModelMasker("m2", device="cpu").detect(["Zoë", "b"], ("pers",)) == [[(0, 3, "PERSON")]] * 2
    assert maskers.ModelMasker("m2", device="gpu").detect(["Zoë"], ("org",)) == [[]]
    assert calls[-6:] == ["cpu", ("m2", maskers.DISABLED[0]), ("m2", maskers.DISABLED[1]), "gpu", ("m2", maskers.DISABLED[0]), ("m2", maskers.DISABLED[1])]


def test_entry_without_a_package_of_the_training_queries(monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "zstandard", None)
    for name in [m for m in sys.modules if m.startswith("veilwork.llm")]:
        monkeypatch.delitem(sys.modules, name)
    with pytest.warns(UserWarning) if __import__("importlib").util.find_spec("veilwork.llm") else __import__("contextlib").nullcontext():
        names = set(entry.queries())
    assert "redact_two_pass" in names and not any(n.startswith("p8") for n in names)


def test_checkpoints_need_a_shared_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    from veilwork.functions.durable import durable

    context = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isEmpty=lambda: True))))
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        durable(SimpleNamespace(sparkSession=session))
