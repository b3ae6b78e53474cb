import pytest
from pyspark.sql import functions as F

from lexmill.functions import rules
from lexmill.functions import text as T


def one(spark, column, **values):
    """The value of a column over one row of literals."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("make", "text", "want"),
    [
        (T.normalize_surface, " Straße  ÉTÉ\n", "strasse été"),
        (T.normalize_phrase, " (Acme  Ltd.), ", "Acme Ltd"),
        (T.normalize_title_phrase, "Dr. Who.", "Dr Who"),
        (T.canonical_label, "Organisation", "ORG"),
        (T.canonical_label, "initial", "INITIAL"),
        (T.tokens, "£1,000 a-b É.f", ["£1", "000", "a-b", "é.f"]),
        (T.words, " a b  c ", 3),
        (T.words, "", 0),
        (T.make_initials, "Dr. Ada van Lace", "A.V.L."),
        (T.make_initials, "", ""),
        (T.clean_person_part, "Anne-Marie 7 O'Neil!", "Anne-Marie O'Neil"),
        (T.clean_company_token, "Acme & Sons (7)", "ACME & SONS 7"),
        (T.lenient_int, " 1,234 ", 1234),
        (T.lenient_int, "x", 0),
        (T.lenient_int, "12.6", 13),
        (T.lenient_int, "2.5", 2),
        (T.lenient_int, "9007199254740993", 9007199254740993),
        (T.section_of_task, "writer_facts_r2_chunk_1", "facts"),
        (T.section_of_task, "writer_witness_report", "witness"),
        (T.section_of_task, "planner_facts", None),
        (T.revision_of_task, "critic_facts_r12", 12),
        (T.doc_counter, "en_indictment_fraud_012", 12),
        (T.doc_counter, "en_x", None),
        (T.json_object_in, '```json\n{"a": {"b": 1}}\n``` tail', '{"a": {"b": 1}}'),
        (T.slug, "Ä b__C--d!", "b-c-d"),
        (T.demote_headings, "# a\n## b\n###### c", "## a\n### b\n###### c"),
        (T.placeholders, "{b} {a} {b} {1}", ["a", "b"]),
        (T.bullets, "- one\n x\n  - two ", ["one", "two"]),
        (T.pipe_fields, "Ann | Role: clerk | x | role: judge", {"name": "Ann", "role": "judge"}),
        (T.clean_generated, "<think>x\ny</think>Hello ,  you\r\n```\nWord count: 9\n**Issues: z**\n\n\n\nFacts:\nEnd", "Hello, you\n\nEnd"),
    ],
)
def test_text_functions(spark, make, text, want):
    assert one(spark, make(F.col("t")), t=text) == want
    assert spark.sql("select cast(null as string) t").select(make(F.col("t"))).first() is not None  # nulls don't crash


def test_numbers_and_bands(spark):
    rows = spark.createDataFrame([(2500, 84.9), (500, 85.0), (3_725_000, 50.0), (61_500, 49.0)], "ms long, s double")
    got = [tuple(r) for r in rows.select(T.duration_text(F.col("ms")), T.latency_band(F.col("ms")), T.verdict(F.col("s"))).collect()]
    assert got == [("2s", "very fast", "acceptable"), ("0s", "very fast", "good"), ("1h 2m 5s", "very slow", "risky"), ("1m 2s", "fast", "bad")]
    assert one(spark, T.percent(F.col("v")), v=0.12345) == "12.35%" or one(spark, T.percent(F.col("v")), v=0.12345) == "12.34%"
    assert one(spark, T.half_even(F.col("v")), v=2.5) == 2


def test_addresses_and_fields(spark):
    rows = spark.createDataFrame([("1 A St, B, C",), ("1 A St,C",), ("x",), ("",)], "a string")
    street, city = T.split_address(F.col("a"))
    assert [tuple(r) for r in rows.select(street, city).collect()] == [("1 A St, B", "C"), ("1 A St", "C"), ("x", ""), ("", "")]
    assert one(spark, T.field_after(F.col("t"), "dob:"), t="Ann | DOB: 3 May 1990 | x") == "3 May 1990"
    assert one(spark, T.field_after(F.col("t"), "dob:"), t="Ann") == ""
    assert one(spark, T.fill_template(F.lit("{a} {b}"), F.create_map(F.lit("a"), F.lit("x")))) == "x {b}"
    assert one(spark, T.truncate_middle(F.col("t"), 4, "~"), t="abcdef") == "ab~ef"


def test_markdown_blocks(spark):
    memory = "## Organisations\n- A\n- B\n### Sub\n- C\n## Counts\n- D"
    assert one(spark, T.markdown_block(F.col("t"), "Organisations"), t=memory) == "- A\n- B\n### Sub\n- C"
    assert one(spark, T.bullets(T.markdown_section(F.col("t"), "Organisations")), t=memory) == ["A", "B"]
    assert one(spark, T.bullets(T.markdown_section(F.col("t"), "Sub")), t=memory) == ["C"]
    assert one(spark, T.markdown_block(F.col("t"), "None"), t=memory) == ""


def issues(spark, text, enabled=None, **more):
    schema = "text string, section string, word_target int, allowed_dates array<string>, allowed_orgs array<string>, known_entities array<string>, defendants array<string>, organisations array<string>, charged_period string, key_dates array<string>, people array<struct<name:string,dob:string,nationality:string,role:string,address:string>>, companies array<struct<name:string,vat:string,address:string>>"
    row = {"text": text, "section": "history", "word_target": 0} | more
    names = [x.split()[0] for x in schema.split(", ")]
    frame = spark.createDataFrame([tuple(row.get(n) for n in names)], schema)
    return rules.issues(frame, enabled).first().issues


PROSE = "The parties met in the town and agreed on the terms of their contract before the end of the year passed. " * 4
PROSE = " ".join(f"{s} number {i}." for i, s in enumerate(f"{a} walked slowly along the river towards the {b}" for a in ("Anna", "Boris", "Clara", "David") for b in ("mill", "church", "harbour")))


def test_clean_prose_has_no_issues(spark):
    assert issues(spark, PROSE) == []


@pytest.mark.parametrize(
    ("text", "issue"),
    [
        ("", "Section is empty."),
        ("[section not generated]", "Section contains placeholder text."),
        (PROSE + " <THINK>", "Section still contains hidden reasoning markup."),
        (PROSE + " ****", "Section contains unresolved placeholder markers (****)."),
        (PROSE + " FIX:this", "Section contains review/instruction metadata instead of prose."),
        ("# Title\n" + PROSE, "Section contains markdown/list formatting; output must be plain prose."),
        (PROSE + " between and then.", "Section contains an incomplete date range ('between ... and ...')."),
        (PROSE + " between the two.", "Section contains a dangling 'between' phrase."),
        (PROSE + " It started on and lasted until May.", "Section contains unresolved timeline placeholders."),
        (PROSE + " VAT: GB12", "Section contains a truncated VAT/reference identifier."),
        (PROSE + " This sentence is longer than eighty characters so that it counts as a long one here, truly." * 2, "Section contains repeated long sentences/paragraphs."),
        (PROSE + " He then went to the old house near the wide lake. He then went to the old house near the wide lake again.", "Section contains repeated sentence fragments."),
        (PROSE + " He went to", "Section appears truncated or ends mid-sentence."),
        ("Too short.", "Section is significantly shorter than the requested target."),
        (PROSE + " On 3 May 2020 it rained.", "Section mentions unknown date '3 May 2020'."),
        (PROSE + " Paid £1,000 at once.", "Section mentions unknown amount '£1,000'."),
        (PROSE + " See CPS/2024/0001 there.", "Section mentions unknown case reference 'CPS/2024/0001'."),
        (PROSE + " No GB123456789 is known.", "Section mentions unknown VAT/reference number 'GB123456789'."),
        (PROSE + " From ACME TRADE LTD it came.", "Section mentions unknown organisation 'ACME TRADE LTD'."),
        (PROSE + " So Mr. Smith left.", "Section mentions unknown titled person 'Mr Smith'."),
    ],
)
def test_each_rule_finds_its_issue(spark, text, issue):
    assert issue in issues(spark, text)


def test_rules_see_facts(spark):
    text = PROSE + " On 3 May 2020 it rained at ACME LTD."
    assert issues(spark, text, allowed_dates=["3 May 2020"], allowed_orgs=["The Acme Ltd Group"]) == []
    assert issues(spark, PROSE, known_entities=["Zoe Long"]) == ["Section does not mention any known case entity."]
    assert issues(spark, PROSE, known_entities=["Zoe"]) == []
    assert issues(spark, PROSE, section="persons", people=[("Anna", "1 May 1980", "", None, None)]) == ["Section is missing required person dob '1 May 1980'."]
    assert issues(spark, PROSE, section="companies", companies=[("ACME", "", None)]) == ["Section is missing required company name 'ACME'."]
    got = issues(spark, PROSE, section="facts", defendants=["Anna", "X", "Y"], organisations=["O"], charged_period="1 May 2020 and 2 May 2020")
    assert got == ["Facts section omits key defendants listed in CASE_MEMORY.", "Facts section omits key organisations listed in CASE_MEMORY.", "Facts section omits one or both charged-period dates from CASE_MEMORY."]
    assert issues(spark, PROSE, section="facts", key_dates=["9 May 2020"]) == ["Facts section omits key case dates from CASE_MEMORY."]


def test_rules_can_be_turned_off(spark):
    assert issues(spark, "Too short.", {"minimum_length": False, "unheard_of": True}) == []
    assert issues(spark, " \n", {"empty_section": False}) == []
    assert len(rules.RULES) == 26
