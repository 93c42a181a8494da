"""Url verdicts: parsing, nesting, skew of the salt, and edge rows."""

from chainlytics.llm import urls as U

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("allow", "example.org/es/x"), ("block", "a.example.org/es/"), ("block", "com/de/")]


def judged(spark, rows, rules=RULES, **more):
    found = U.judge(spark.createDataFrame(rows, "page_id bigint, url string"), U.rule_table(spark, rules), **more)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}


def test_longest_rule_of_a_host_and_its_subdomains(spark):
    rows = [
        (0, "http://Example.ORG/es/1?q#f"), (1, "http://example.org/es/x1"), (2, "https://a.example.org/es/x/"), (3, "http://b.a.example.org/es/"),
        (4, "http://myexample.org/es/"), (5, "http://example.org"), (6, "http://x.com/de/1"), (7, "http://x.net/"), (8, "http://org/"), (9, "http://com.example/de/"),
    ]
    got = judged(spark, rows)
    assert got[0] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[1][2:] == ("example.org/es/x", "allow")
    assert got[2][2:] == ("a.example.org/es/", "block") and got[3][2:] == ("a.example.org/es/", "block")
    assert got[4][2:] == ("org/", "allow")
    assert got[5] == ("example.org", "", None, "allow")  # no path: no rule's path starts it
    assert got[6][2:] == ("com/de/", "block") and got[7][2:] == (None, "allow") and got[8][2:] == ("org/", "allow")
    assert got[9][2:] == (None, "allow")


def test_rows_without_a_host(spark):
    got = judged(spark, [(1, None), (2, ""), (3, "example.org/es/"), (4, "://"), (5, "http:///es/"), (None, "a://org/\n?x"), (6, "x://a://org/")])
    assert got[1] == got[2] == got[3] == got[4] == ("", "", None, "allow") and got[5] == ("", "/es/", None, "allow")
    assert got[None] == ("org", "/\n", "org/", "allow") and got[6] == ("a:", "//org/", None, "allow")


def test_all_rows_stay_with_any_number_of_salts(spark):
    rows = [(n, "http://a.example.org/es/") for n in range(300)] * 2
    for salts in (1, 7):
        found = U.judge(spark.createDataFrame(rows, "page_id bigint, url string"), U.rule_table(spark, RULES), salts=salts)
        assert found.count() == 600 and found.where("verdict = 'block'").count() == 600


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert U.judge(none, U.rule_table(spark, RULES)).count() == 0
    clash = spark.createDataFrame([(1, "http://org/", 7, "k", "s")], "page_id bigint, url string, rule int, key string, stack string")
    row = U.judge(clash, U.rule_table(spark, RULES)).first()
    assert (row["rule"], row["key"], row["stack"], row["page_id"]) == ("org/", "k", "s", 1)


def test_no_python_in_the_plan(spark):
    from conftest import physical

    plan = physical(U.judge(spark.createDataFrame([(1, "x")], "page_id bigint, url string"), U.rule_table(spark, RULES)))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
