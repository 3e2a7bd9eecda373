"""Column functions on hand-written values, the surprising cases included."""

import ast

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.functions import coerce, lists, text, urls


def test_strip_control_keeps_what_lies_above_the_range(apply):
    assert apply(text.strip_control, ["a\tb\nc", "\x00x\x19", "\x1a\x1f", None]) == [
        "abc",
        "x",
        "\x1a\x1f",
        None,
    ]


def test_alpha_only(apply):
    assert apply(text.alpha_only, [" 2 cups-flour ", "é1", ""]) == ["cupsflour", "", ""]


def test_missing_if_blank(apply):
    assert apply(text.missing_if_blank, ["", None, " ", "pie"]) == ["missing", "missing", " ", "pie"]


def test_make_uid_keeps_letters_of_all_scripts(apply):
    uids = apply(lambda c: text.make_uid(c, F.lit(7)), ["Crème Brûlée!", "a_b c", "!!"])
    assert uids == ["crèmebrûlée_7", "a_bc_7", "_7"]


def test_collapse_ws(apply):
    assert apply(text.collapse_ws, ["A\t\n B", "x  y", "", None]) == ["a b", "x y", "", None]


def test_clean_and_split_text(apply):
    rows = [["Red-Onion ", "  ", "!!", "2 Eggs"], [], None]
    assert apply(text.clean_text, rows, "array<string>") == [["redonion ", "2 eggs"], [], None]
    assert apply(text.split_text, [["a  b", " c "], []], "array<string>") == [["a", "b", "c"], []]


def test_file_names(apply):
    name = apply(lambda c: text.json_filename(F.lit(3), c), ["www.x.com", None])
    assert name == ["3_www_x_com.json", "3_.json"]
    cut = apply(text.truncate_filename, ["a" * 2000, "b"])
    assert [len(c) for c in cut] == [1024, 6]


def test_ensure_https(apply):
    links = ["https://a.com", "http://a.com", "www.a.com", None]
    assert apply(urls.ensure_https, links) == ["https://a.com", "https://a.com", "https://www.a.com", None]
    legacy = apply(lambda c: urls.ensure_https(c, legacy=True), links)
    assert legacy[1] == "https://http://a.com"
    assert apply(urls.url_host, [legacy[1]]) == ["http"]


def test_url_dirname(apply):
    got = apply(urls.url_dirname, ["https://x.com", "https://x.com/a/b", "https://x.com/a/", "none"])
    assert got == ["https:", "https://x.com/a", "https://x.com/a", "NA"]


def test_url_host(apply):
    got = apply(
        urls.url_host,
        ["https:", "https://U:p@WWW.X.com:80/a", "https://u_v.com", "https://[::1]:9/", "x", None],
    )
    assert got == [None, "www.x.com", "u_v.com", "::1", None, None]


def test_base_url_and_site(apply):
    links = [
        "https://www.food.com/recipe/x",
        "https://www.a.org/b.com",
        "https://cook.net/1",
        "ftp//none",
        "https://a.co",
    ]
    assert apply(urls.extract_base_url, links) == ["www.food.com", "www.a.org/b.com", "NA", "NA", "NA"]
    assert apply(urls.extract_site_source, links) == ["food", "a.org/b", None, "NA", None]


def test_gathered_source(apply):
    base = F.lit("https://www.A.com/x")
    got = apply(lambda c: urls.gathered_source(c, base), ["Gathered", "Recipes1M", None])
    assert got == ["www.a.com", "Recipes1M", None]


def test_prefix_site(apply):
    got = apply(lambda c: urls.prefix_site(c, "https://s.com"), ["/a", "b", "https://o.com/", "//o.com"])
    assert got == ["https://s.com/a", "https://s.com/b", "https://o.com/", "https://o.com"]
    assert apply(lambda c: urls.prefix_site(c, "https://s.com", legacy=True), ["x"]) == ["https://s.comx"]


def test_coerce(apply):
    values = ["12", " 7 ", "4.7", "45 min", "", None, "1e2", "nan", "true", "9007199254740993"]
    assert apply(coerce.to_int_or_zero, values) == [12, 7, 4, 0, 0, 0, 100, 0, 1, 9007199254740993]
    assert apply(coerce.to_float_or_zero, values)[:4] == [12.0, 7.0, 4.7, 0.0]
    assert apply(coerce.has_fraction, values)[:4] == [False, False, True, False]


def test_split_commas(apply):
    assert apply(lists.split_commas, ["a, b,", "", None]) == [["a", " b", ""], [""], None]


def test_lowercase_sort_is_stable(apply):
    got = apply(lists.lowercase_sort, [["b", "A", "a", "B", "é"], [], None], "array<string>")
    assert got == [["A", "a", "b", "B", "é"], [], None]


def test_json_round_trip(apply):
    rows = [["é", 'q"q', "a/b"], [], None]
    wrapped = apply(lambda c: lists.wrap_json(c, "k"), rows, "array<string>")
    assert wrapped == ['{"k":["é","q\\"q","a/b"]}', '{"k":[]}', '{"k":null}']
    assert apply(lambda c: lists.unwrap_json(c, "k"), wrapped) == rows


def test_python_lists(apply):
    literals = [
        """['a', "it's"]""",
        '["x", "y"]',
        r"['it\'s', 'b\x41']",
        r"['tab\there', 'é']",
        "[]",
        "['a',]",
        "['a' 'b']",
        "[None, 1]",
        "['a'",
        "['a'] x",
        "[true]",
        "['a', null]",
        "[['a']]",
        r"['a\/b', '\u00e9']",
        "{'a': 1}",
        "",
        None,
    ]
    assert apply(lists.parse_py_list, literals) == [
        ["a", "it's"],
        ["x", "y"],
        ["it's", "bA"],
        ["tab\there", "é"],
        [],
        ["a"],
        ["ab"],
        [None, "1"],
        None,
        None,
        None,
        None,
        ["['a']"],
        ["a\\/b", "é"],
        None,
        None,
        None,
    ]


def test_long_literals_stay_out_of_python(apply):
    long = repr(["a'" * 40_000, "b\n" * 40_000] + ["x"] * 20_000)
    assert [len(v) for v in apply(lists.quick_list, [long])] == [20_002]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.text(max_size=12), max_size=4), min_size=40, max_size=60))
def test_python_lists_match_the_literal_reader(spark, rows):
    rows = [[t.encode("utf-8", "ignore").decode().replace("\x00", "") for t in r] for r in rows]
    literals = [repr(r) for r in rows]
    df = spark.createDataFrame(list(enumerate(literals)), "i long, v string")
    out = df.select("i", lists.parse_py_list(F.col("v")).alias("o")).orderBy("i").collect()
    assert [r["o"] for r in out] == [ast.literal_eval(t) for t in literals]
