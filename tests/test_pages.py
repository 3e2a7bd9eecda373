"""Links, labels, closure and recipe records of hand-written pages."""

import json
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from larder.operators import pages as px
from larder.operators.recipes import page_record
from larder.plans import discover as dx
from larder.sources import tables
from larder.sources.tables import bucket_count, pages_for, read_pages
from larder.sinks.tables import write_pages

HTML = """<html><body><!-- <a href="https://www.allrecipes.com/recipe/9/in-comment/">x</a> -->
<script>var s = '<a href="/script">x</a>';</script>
<nav id="main-nav"><ul><li><a href="/ideas/a?x=1&amp;y=2">A</a><li><a href="">empty</a><a>none</a></ul></nav>
<div id="alphabetical-list-1"><p><a href='https://x.com/b'>B<br></a></div>
<a class="c" href=https://x.com/plain>See Them All</a>
<A HREF="https://www.allrecipes.com/recipe/73794/spanish-squash/">recipe</A>
<a href="https://www.allrecipes.com/recipes/17561/lunch/">not a recipe</a>
<a href="https://www.food.com/recipe/lenten-lentils-85328#x"><b>See Them All</b></a>
<a href="https://www.food.com/recipe/lentils">near miss</a>
<a href="/more"><i></i>See Them All</a><nav><a href="/foot">f</a></nav></body></html>"""


@pytest.fixture
def page(spark):
    return spark.createDataFrame([("https://p.com", HTML), ("https://e.com", ""), ("https://n.com", None)], "url string, html string")


def hrefs(df):
    return [r["href"] for r in df.orderBy("pos").collect()]


ALL = [
    "/ideas/a?x=1&y=2",
    "",
    "https://x.com/b",
    "https://x.com/plain",
    "https://www.allrecipes.com/recipe/73794/spanish-squash/",
    "https://www.allrecipes.com/recipes/17561/lunch/",
    "https://www.food.com/recipe/lenten-lentils-85328#x",
    "https://www.food.com/recipe/lentils",
    "/more",
    "/foot",
]


def test_links_both_ways(page):
    assert hrefs(px.extract_links(page, ["url"])) == ALL
    assert hrefs(px.anchors(page, ["url"])) == ALL


def test_recipe_links(page):
    rows = px.recipe_links(px.extract_links(page, ["url"])).orderBy("pos").collect()
    assert [(r["site"], r["href"]) for r in rows] == [
        ("allrecipes", ALL[4]),
        ("fooddotcom", ALL[6]),
    ]


def test_links_by_place_and_label(page):
    found = px.anchors(page, ["url"])
    assert hrefs(px.section_links(found)) == ["https://x.com/b"]
    assert hrefs(px.nav_links(found)) == ["/ideas/a?x=1&y=2"]
    assert hrefs(px.nav_links(found, element_id=None)) == ["/ideas/a?x=1&y=2", "/foot"]
    assert hrefs(px.labelled_links(found)) == ["https://x.com/plain", ALL[6]]


def test_very_long_pages(spark):
    """Patterns over megabytes of markup neither recurse nor cut the text."""
    html = "<!--" + "x<" * 800_000 + "-->" + "<script>" + "y" * 500_000 + "</script>" + link("/end")
    pages = spark.createDataFrame([("u", html)], "url string, html string")
    assert hrefs(px.extract_links(pages, ["url"])) == ["/end"]
    r = record(spark, json.dumps({**RECIPE, "description": "d" * 1_000_000}), html)
    assert (r["title"], len(r["description"])) == ("Lenten Lentils", 1_000_000)


def test_top_links(page):
    assert hrefs(px.top_links(page, ["url"], 2)) == ALL[:2]
    assert hrefs(px.top_links(page, ["url"], 9, "^https://www")) == ALL[4:8]


def test_replace_by_label(spark):
    starts = spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "url string")
    labelled = spark.createDataFrame([("a", "x"), ("a", "y"), ("z", "w")], "url string, href string")
    got = sorted(r["url"] for r in px.replace_by_label(starts, labelled).collect())
    assert got == ["b", "c", "x", "y"]


def brute_closure(seeds, edges):
    depth, frontier, d = dict.fromkeys(seeds, 0), set(seeds), 0
    while frontier:
        d += 1
        frontier = {t for s, t in edges if s in frontier} - set(depth)
        depth.update(dict.fromkeys(frontier, d))
    return depth


def test_closure_of_a_cyclic_graph(spark):
    rng = random.Random(2)
    edges = [(f"p{rng.randrange(60)}", f"p{rng.randrange(60)}") for _ in range(90)] + [("p1", "p2"), ("p2", "p1")]
    seeds = spark.createDataFrame([("p1",), ("p7",), ("p1",)], "node string")
    frame = spark.createDataFrame(edges, "src string, dst string")
    got = {r["node"]: r["depth"] for r in px.link_closure(seeds, frame).collect()}
    assert got == brute_closure(["p1", "p7"], edges)
    near = {r["node"] for r in px.link_closure(seeds, frame, max_depth=1).collect()}
    assert near == {n for n, d in got.items() if d <= 1}


RECIPE = {
    "@context": "https://schema.org",
    "@type": ["Recipe", "NewsArticle"],
    "name": "Lenten Lentils",
    "image": {"url": "https://i.com/1.jpg"},
    "author": [{"@type": "Person", "name": "Edna"}],
    "recipeYield": ["4"],
    "prepTime": "PT15M",
    "cookTime": "P0DT1H",
    "recipeIngredient": ["3/4 cup dried lentils", "4 cups water"],
    "recipeInstructions": [
        {"@type": "HowToSection", "itemListElement": [{"text": "Boil."}, {"text": "Simmer."}]},
        {"@type": "HowToStep", "text": "Serve."},
    ],
    "recipeCategory": "One Dish Meal",
    "recipeCuisine": ["Mexican", "European"],
    "aggregateRating": {"ratingValue": 5},
}


def record(spark, doc, rest="<title>T &amp; t</title>"):
    html = f'<html lang="en"><script type="application/ld+json">{doc}</script>{rest}</html>'
    pages = spark.createDataFrame([("https://www.food.com/recipe/x", html)], "url string, html string")
    return page_record(pages).first()


@pytest.mark.parametrize("wrap", [lambda r: r, lambda r: [{"@type": "WebSite"}, r], lambda r: {"@graph": [r]}])
def test_recipe_record(spark, wrap):
    r = record(spark, json.dumps(wrap(RECIPE)))
    assert (r["title"], r["host"], r["canonical_url"]) == ("Lenten Lentils", "food.com", r["url"])
    assert (r["image"], r["author"], r["yields"]) == ("https://i.com/1.jpg", "Edna", "4 servings")
    assert (r["prep_time"], r["cook_time"], r["total_time"]) == (15, 60, 75)
    assert r["ingredients"] == RECIPE["recipeIngredient"]
    assert r["instructions_list"] == ["Boil.", "Simmer.", "Serve."]
    assert (r["category"], r["cuisine"], r["ratings"]) == ("One Dish Meal", "Mexican,European", 5.0)
    assert r["language"] == "en"


def test_record_without_a_recipe(spark):
    for doc in ("{broken", '{"@type": "WebSite"}', "[]"):
        r = record(spark, doc)
        assert (r["title"], r["ingredients"], r["total_time"]) == ("T & t", None, None)
    assert record(spark, "", "<h1>A <b>B</b></h1><title>T</title>")["title"] == "A B"


def link(href, text="x"):
    return f'<a href="{href}">{text}</a>'


def test_discovery_of_both_sites(spark):
    recipe_a, recipe_f = "https://www.allrecipes.com/recipe/1/a-b/", "https://www.food.com/recipe/c-d-{}"
    more = "See Them All"
    site = {
        dx.ALLRECIPES_AZ[0]: f'<div id="alphabetical-list-1">{link("https://sec")}</div>{link("https://other")}',
        "https://sec": link(recipe_a) + link(recipe_a),
        "https://other": link("https://www.allrecipes.com/recipe/2/no-no/"),
        dx.ALLRECIPES_SEEDS[0]: link(recipe_a),
        dx.FOODDOTCOM_SEEDS[0]: link("https://m1", more) + link(recipe_f.format(1)),
        "https://m1": link("https://m2", more) + link(recipe_f.format(2)),
        "https://m2": link("https://m1", more) + link(recipe_f.format(3)),
        dx.FOODDOTCOM_NAV: f'<nav id="main-nav">{link("/n1")}{link("/n2")}</nav>',
        "https://www.food.com/n1": link("https://n1all", more) + link(recipe_f.format(4)),
        "https://www.food.com/n2": link(recipe_f.format(5)),
        "https://n1all": link(recipe_f.format(6)),
    }
    pages = spark.createDataFrame(list(site.items()), "url string, html string")
    got = sorted(r["url"] for r in dx.all_recipe_urls(pages).collect())
    assert got == [recipe_a] * 3 + [recipe_f.format(i) for i in (1, 2, 3, 5, 6)]


def scanned(frame):
    """Rows that the scan of pages gave out, and the files it opened."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i).metrics() for i in range(leaves.size())]
    found = [(m.apply("numOutputRows").value(), m.apply("numFiles").value()) for m in scans if m.contains("numFiles")]
    return found[0]


def address(i):
    return f"https://x/{zlib.crc32(str(i).encode()):08x}/{i}"


def test_lookup_opens_only_what_can_hold_its_urls(spark, tmp_path):
    rows = [(address(i), f"{i}" * 200) for i in range(8000)] + [(None, "no url")]
    pages = spark.createDataFrame(rows, "url string, html string")
    write_pages(pages, str(tmp_path / "pages"), buckets=16, row_group_bytes=16 << 10)
    stored = read_pages(spark, str(tmp_path / "pages"))
    assert bucket_count(stored) == 16 and stored.count() == 8001
    urls = spark.createDataFrame([(address(5),), (address(5),), ("https://none",), ("",), (None,)], "url string")
    found = pages_for(urls, stored)
    assert [r["url"] for r in found.collect()] == [address(5)] and found.columns == ["url", "html"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*url_bucket#\d+ IN \(", plan)
    assert re.search(r"PushedFilters: \[[^\]]*In\(url", plan)
    given, files = scanned(found)
    assert given < 400 and files <= 3
    # Between the first and the last URL of their row groups, so only the Bloom filter tells.
    absent = [f"https://x/{i:07x}z" for i in range(0, 1 << 28, 1 << 24)]
    missing = pages_for(spark.createDataFrame([(a,) for a in absent], "url string"), stored)
    assert scanned(missing)[0] <= 400
    assert pages_for(urls.limit(0), stored).count() == 0


def test_lookup_of_many_urls_prunes_folders(spark, tmp_path, monkeypatch):
    pages = spark.range(200).select(F.concat(F.lit("https://x/"), "id").alias("url"), F.lit("h").alias("html"))
    write_pages(pages, str(tmp_path / "pages"), buckets=16)
    monkeypatch.setattr(tables, "LOOKUP_URLS", 1)
    urls = spark.createDataFrame([("https://x/5",), ("https://x/7",), ("https://none",)], "url string")
    for stored in (read_pages(spark, str(tmp_path / "pages")), pages):
        found = pages_for(urls, stored)
        assert sorted(r["url"] for r in found.collect()) == ["https://x/5", "https://x/7"]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and ("dynamicpruning" in plan) == (stored is not pages)
    write_pages(pages.limit(0), str(tmp_path / "none"), buckets=4)
    assert pages_for(urls, read_pages(spark, str(tmp_path / "none"))).count() == 0


CODED = [
    '<a href="/1">See Them All</a>',
    '<a href="/2"><b>See Them All</b></a>',
    '<a href="/3">&#83;ee Them All</a>',
    '<a href="/4">See&#32;Them&#x20;All</a>',
    '<a href="/5">See Them Al&#108;</a>',
    '<a href="/6">See Them All!</a>',
    '<a href="/7">See<!-- x -->Them All</a>',
    '<a href="/8">Tom &amp; Jerry</a> <p>&nbsp;x</p>',
    '<div id="alphabetical-list-9"><a href="/9">x</a></div>',
    '<div ID = alphabetical-list><a href="/10">x</a></div>',
    "<div id='&#97;lphabetical-list'><a href='/11'>x</a></div>",
    '<div id="alphabetica&#108;-list"><a href="/12">x</a></div>',
    '<div id="list alphabetical-list"><a href="/13">x</a></div>',
    '<p>alphabetical-list</p><a href="/14">x</a>',
    "",
    None,
]


def test_pages_left_out_of_python_have_nothing_to_find(spark):
    rows = list(enumerate(CODED)) + [(100 + i, f"<a href='/x{i}'>plain</a>") for i in range(50)]
    pages = spark.createDataFrame(rows, "url int, html string")
    for may, links in (
        (px.may_hold_text(F.col("html"), px.MORE_LABEL), px.labelled_links),
        (px.may_hold_id(F.col("html"), px.SECTION_ID_PREFIX), px.section_links),
    ):
        asked = pages.where(may)
        got, want = (sorted(r["href"] for r in links(px.anchors(p, ["url"])).collect()) for p in (asked, pages))
        assert got == want and len(want) >= 4 and asked.count() <= len(want) + 2
    # A label with other characters may begin with any reference, here with that of another letter.
    asked = pages.where(px.may_hold_text(F.col("html"), "Tom & Jerry"))
    assert sorted(r["url"] for r in asked.collect()) == [2, 7]


def test_discovery_parses_only_pages_with_a_label(spark, monkeypatch):
    """Of a crawl of a thousand pages, those with a label and the navigation go to Python."""
    parsed = []
    real = dx.anchors
    monkeypatch.setattr(dx, "anchors", lambda p, keep: parsed.append(p.count()) or real(p, keep))
    rows = [(f"https://www.food.com/n{i}", '<a href="https://www.food.com/recipe/a-b-%d">x</a>' % i) for i in range(1000)]
    rows += [(dx.FOODDOTCOM_NAV, '<nav id="main-nav"><a href="/n1">1</a></nav>'),
             (dx.FOODDOTCOM_SEEDS[0], '<a href="https://www.food.com/n2">See Them All</a>')]
    pages = spark.createDataFrame(rows, "url string, html string")
    found = sorted(r["url"] for r in dx.fooddotcom_urls(pages).collect())
    assert found == [f"https://www.food.com/recipe/a-b-{i}" for i in (1, 2)]
    assert parsed == [1, 1]


def _shuffled(spark, work):
    """Bytes written to shuffles by some work."""
    context = spark.sparkContext._jsc.sc()

    def total():
        context.listenerBus().waitUntilEmpty()
        executors = context.statusStore().executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    before = total()
    result = work()
    return total() - before, result


def test_a_round_moves_its_frontier_only(spark):
    """A long chain among very many other links: rounds shuffle next to nothing of them."""
    far = spark.range(400_000).select((F.col("id") * 2 + 10**9).alias("src"), (F.col("id") * 2 + 10**9 + 1).alias("dst"))
    chain = spark.range(6).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # No side is broadcast, as with a large frontier.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        laying, edges = _shuffled(spark, lambda: px.lay_edges(far.unionByName(chain)))
        seeds = spark.createDataFrame([(0,)], "node long")
        rounds, nodes = _shuffled(spark, lambda: px.link_closure(seeds, edges, laid=True).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r["node"], r["depth"]) for r in nodes) == [(i, i) for i in range(7)]
    assert laying > 2_000_000 and rounds < laying / 50
