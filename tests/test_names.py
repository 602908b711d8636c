from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contactloom.functions import names
from contactloom.operators import permute


def column(spark, expr, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v")).alias("x")).collect()]


def test_tokens(spark):
    assert column(spark, names.name_tokens, "Dr. Zoé Mary-Lou O'Dell", "—", None, "Prof. Åsa  Straße", "ﬁona Łuk", " ") == [["zoe", "marylou", "odell"], [], [], ["asa", "strae"], ["fiona", "uk"], []]


def test_display_name(spark):
    assert [tuple(d) for d in column(spark, names.display_name, "Dr Ana van der Quill", "Zed", None, "")] == [("Ana", "van der Quill"), ("Zed", ""), ("", ""), ("", "")]


def test_keys(spark):
    assert column(spark, names.person_key, "O'Brien,  Ann", "É. Ünal") == ["obrien ann", "é ünal"]
    assert column(spark, lambda v: names.master_key(F.lit("a.example"), v), "O'Brien") == ["a.example::o brien"]


def permuted(spark, rows):
    df = spark.createDataFrame(rows, "id int, name string, company_domain string, email_domain string")
    out = {}
    for r in permute.long_table(df, ["id"], "name").orderBy("id", "rank").collect():
        out.setdefault(r.id, []).append((r.rank, r.pattern, r.email))
    return out


def test_candidates(spark):
    found = permuted(spark, [(1, "Ada Quill", "example.com", None), (2, "Ada Ash", "example.com", " Mail.Example.org "), (3, "Zed", "example.com", None), (4, "Ada Quill", " ", ""), (5, None, "example.com", None)])
    assert len(found[1]) == 18 and found[1][0] == (1, "first.last", "ada.quill@example.com")
    assert [r for r, _, _ in found[2]] == list(range(1, 17)) and found[2][0][2] == "ada.ash@mail.example.org"
    assert set(found) == {1, 2}


def test_wide_rows_are_the_long_ones_and_take_no_search_for_patterns(spark):
    names_ = ("Ada Quill", "Ada Ash", "A A", "Ab Ab", "Zed", "", None, "Dr Bo van Dee", "é ü")
    df = spark.createDataFrame([(i, n, None if i == 3 else "Example.com ", None) for i, n in enumerate(names_)], "id long, name string, company_domain string, email_domain string")
    for limit in (1, 5, 18):
        wide = permute.wide_table(df, ["id"], "name", limit=limit)
        long = Counter((r.id, r["rank"], r.email) for r in permute.long_table(df, ["id"], "name", limit=limit).collect())
        assert wide.columns == ["id", *[f"email_{k + 1}" for k in range(limit)]] and wide.count() == len(names_)
        assert Counter((r.id, k + 1, r[f"email_{k + 1}"]) for r in wide.collect() for k in range(limit) if r[f"email_{k + 1}"]) == long
    assert "array_position" not in wide._jdf.queryExecution().executedPlan().toString()


def test_names_of_a_table_in_one_file_are_worked_on_by_all_cores(spark):
    from contactloom.plans import name_queries

    assert name_queries.people(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.text("abcé -'", max_size=8), st.text("abcxyz", min_size=1, max_size=5)), min_size=1, max_size=20))
def test_ranks_have_no_gaps_and_addresses_are_distinct(spark, given_names):
    for rows in permuted(spark, [(i, f"{a} {b}", "example.com", None) for i, (a, b) in enumerate(given_names)]).values():
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1))
        assert len({e for _, _, e in rows}) == len(rows) and not any("_" in e or "-" in e for _, _, e in rows)


def test_templates(spark):
    apply = lambda t, n: column(spark, lambda v: names.build_email(F.lit(t), names.name_tokens(v), F.lit("example.com")), n)[0]
    assert apply("{fi}_{last}", "Ada Quill") == "a_quill@example.com" and apply("filast", "Ada Quill") == "aquill@example.com"
    assert apply("{last}", "Zed") is None and apply("{first}", "Zed") == "zed@example.com" and apply("x y {first}", "Ada Quill") is None and apply("unknown", "Ada Quill") is None


def test_bad_pattern_is_refused():
    import pytest

    with pytest.raises(ValueError):
        names.local_part("first_last", F.lit("a"), F.lit("b"))
