import json

import pytest
from pyspark.sql import functions as F

from lexmill.functions import names
from lexmill.operators import memory
from lexmill.sources import config

MEMORY = """# CASE_MEMORY

## Document
- Doc ID: test_doc
- Filing date: 1 February 2025

## Defendants
- Ann Lee | role: director | nationality: British | address: 1 Test Street, Leeds
- none

## Collateral
- Bo Ray | role: clerk

## Organisations
- ACME TRADING LTD | VAT: GB123456789 | address: 3 Test Street

## Counts
- Fraud | section 2 of the Fraud Act 2006 | between 1 January 2025 and
  31 January 2025 causing loss of £10,000.

## Allowed References
### Case References and Dates
- CPS/2025/0001
- 1 February 2025

### Allowed Person Surface Forms
- Ann Lee | allowed forms: Ann Lee; Ms. Lee; A.B.C | dob: 1 March 1980

### Allowed Organisations
- ACME TRADING LTD | VAT: GB123456789

### Allowed Amounts
- Total: £10,000

## Document Plan
- CPS/2099/0009
"""


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([("d", MEMORY), ("e", ""), ("n", None)], "doc_id string, memory_text string")


def test_facts(frame):
    got = {r.doc_id: r.asDict() for r in memory.facts(frame).collect()}
    d = got["d"]
    assert d["known_entities"] == ["Ann Lee", "Ms. Lee", "A.B.C", "ACME TRADING LTD"]
    assert (d["allowed_case_refs"], d["allowed_amounts"], d["allowed_vats"], d["allowed_titled"]) == (["CPS/2025/0001"], ["£10,000"], ["GB123456789"], ["Ms Lee"])
    assert set(d["allowed_dates"]) == {"1 February 2025", "1 March 1980", "1 January 2025", "31 January 2025"}
    assert (d["defendants"], d["organisations"], d["charged_period"], d["key_dates"]) == (["Ann Lee"], ["ACME TRADING LTD"], "1 January 2025 and 31 January 2025", ["1 February 2025"])
    assert [tuple(p) for p in d["people"]] == [("Ann Lee", "1 March 1980", "British", "director", "1 Test Street, Leeds"), ("Bo Ray", "", "", "clerk", "")]
    assert [tuple(c) for c in d["companies"]] == [("ACME TRADING LTD", "GB123456789", "3 Test Street")]
    assert got["e"]["known_entities"] == [] and got["e"]["charged_period"] == ""


def test_validate_against_memory(spark, frame):
    text = "Ann Lee of ACME TRADING LTD met Mr. Fox on 2 May 2020 and paid £10,000 under CPS/2025/0001."
    rows = spark.createDataFrame([("d", "history", text, 0), ("x", "history", text, 0)], "doc_id string, section string, text string, word_target int")
    got = {r.doc_id: r.issues for r in memory.validate(rows, frame, {"minimum_length": False}).collect()}
    assert got["d"] == ["Section mentions unknown date '2 May 2020'.", "Section mentions unknown titled person 'Mr Fox'."]
    assert len(got["x"]) == 5


def test_candidates(frame):
    got = [(r.text, r.label) for r in memory.candidates(frame).where("doc_id = 'd'").orderBy("ord").collect()]
    assert ("section 2 of the Fraud Act 2006", "CASE_REFERENCE") in got and ("Ann Lee", "PERSON") in got and ("Bo Ray", "PERSON") in got
    assert ("1 Test Street", "ADDRESS") not in got and ("3 Test Street", "ADDRESS") in got and ("ACME TRADING LTD", "ORG") in got
    assert len(got) == len(set(got)) and ("none", "PERSON") not in got


@pytest.mark.parametrize(
    ("make", "value", "want"),
    [
        (names.nicknames, "Nicolas", ["Nico", "Nicol", "Nic"]),
        (names.nicknames, "Ann", []),
        (names.misspellings, "Zack", ["Sack", "Zakk", "Zacc", "Zak", "Zacck"]),
        (names.end_sentence, "done ", "done."),
        (names.end_sentence, "done!", "done!"),
        (names.is_version, "1.2.3", True),
        (names.is_version, "1.2", False),
        (names.drop_repeats, "a b.\na b.\nc d.", "a b. c d."),
        (names.drop_repeats, f"{'x ' * 50}.\ny.\n{'x ' * 50}.\ny.", f"{'x ' * 50}. y. y."),
    ],
)
def test_names(spark, make, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(make(F.col("v"))).first()[0] == want


def test_variants_and_checks(spark):
    row = spark.range(1).select(names.add_variants(F.array(F.lit("Ann")), F.array(*map(F.lit, ("ann", "An", "AN", " ", "Anne"))), 2).alias("v"), names.output_budget(F.lit(100), 1.5, 10, 120).alias("b"), names.prompt_words(F.lit(1000)).alias("p"), names.content_problems(F.lit("One two. Three."), 5, 9, ("two", "four"), ("three",), 2).alias("c"), names.observation_url(F.lit("http://x?a=1"), F.lit("o")).alias("u"), names.usage_total(F.lit(1), F.lit(None).cast("int")).alias("t")).first()
    assert (row.v, row.b, row.p, row.c, row.u, row.t) == (["An", "Anne"], 120, 1080, ["word count 3", "missing four", "forbidden three"], "http://x?a=1&observation=o", None)


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"a": {"b": "auto", "c": ["auto", 1]}}))
    loaded = config.load(str(tmp_path / "c.json"))
    assert config.auto_paths(loaded) == ["a.b", "a.c[0]"]
    (tmp_path / "l.json").write_text("[1]")
    with pytest.raises(ValueError, match="mapping"):
        config.load(str(tmp_path / "l.json"))
    (tmp_path / ".env").write_text("# c\nexport A='x y'\nB=2\nC=\"\"\nbad line\n")
    assert config.env_file(str(tmp_path / ".env"), {"B": "1"}) == {"A": "x y", "C": ""}
    assert config.env_file(str(tmp_path / "none"), {}) == {}
    assert config.rule_switches({"minimum_length": False})["minimum_length"] is False and len(config.rule_switches(None)) == 26
    for bad in ({"unheard": True}, {"minimum_length": 1}):
        with pytest.raises(ValueError, match="rule"):
            config.rule_switches(bad)
    assert config.scoring({"revision_penalty": 1})["revision_penalty"] == 1
    assert config.fill({"a": ["{x} {y}", 1]}, {"x": "z"}) == {"a": ["z {y}", 1]}
    assert config.resize([{"n": 1}, {"n": 2}], 1, {}) == [{"n": 1}] and config.resize([], 2, {"d": 0}) == [{"d": 0}] * 2
    options = {"vat": "VAT fraud", "aml": "Money laundering"}
    assert [config.choose_scenario(v, options, "aml") for v in ("vat", "VAT FRAUD", "other", None)] == ["vat", "vat", "aml", "aml"]
    assert config.choose_scenario("other", options) == "vat"
    assert config.version("1.2.3") == "1.2.3"
    with pytest.raises(ValueError, match="version"):
        config.version("1.2")
    assert config.enum_names(["a b", "A-B", "1"]) == {"A_B": "a b", "A_B_2": "A-B", "_1": "1"}
