"""Links, labelled links, closure and records of pages."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalogue.registry import query, table, wide_table
from larder.operators import pages as px
from larder.operators.recipes import page_record as record_of
from larder.plans import discover

# The crawled pages carry no ids, so their navigation gets the ones the operators look for.
_MARKED = "replace(replace(html, '<nav>', '<nav id=\"main-nav\">'), '<ul>', '<ul id=\"alphabetical-list-1\">')"
_LINKS = """
WITH h AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hs FROM pages),
l AS (SELECT page_id, url, unnest(hs) AS href, (generate_subscripts(hs, 1) - 1)::INTEGER AS pos FROM h)
"""


def _pages(spark, d):
    return table(spark, d, "pages")


def _anchors(spark, d, keep=("page_id",)):
    marked = wide_table(spark, d, "pages", "page_id", "url", "html").withColumn("html", F.expr(_MARKED))
    return px.anchors(marked, list(keep))


@query(f"{_LINKS} SELECT page_id, pos, href FROM l")
def links(spark, d):
    return px.extract_links(_pages(spark, d), ["page_id"])


@query("""
WITH h AS (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS hs FROM pages),
l AS (SELECT page_id, unnest(hs) AS a, (generate_subscripts(hs, 1) - 1)::INTEGER AS pos FROM h)
SELECT page_id, pos, regexp_extract(a, '"([^"]*)"', 1) AS href, regexp_extract(a, '>([^<]*)<', 1) AS label FROM l
""")
def exact_links(spark, d):
    return _anchors(spark, d).drop("within")


_RULES = {**px.RECIPE_RULES, "crawl": r"^/[a-z]+$", "dotted": r"^/[a-z]+\.$"}
_SITE = "CASE WHEN regexp_matches(href, '^/[a-z]+$') THEN 'crawl' WHEN regexp_matches(href, '^/[a-z]+\\.$') THEN 'dotted' END"


@query(f"{_LINKS} SELECT page_id, pos, href, {_SITE} AS site FROM l WHERE {_SITE} IS NOT NULL")
def recipe_links(spark, d):
    return px.recipe_links(px.extract_links(_pages(spark, d), ["page_id"]), _RULES)


@query("""
WITH h AS (SELECT page_id, list_filter(regexp_extract_all(html, '<a href="([^"]*)">', 1),
  lambda x: regexp_matches(x, '^/[a-z]+$'))[1:2] AS hs FROM pages)
SELECT page_id, unnest(hs) AS href, (generate_subscripts(hs, 1) - 1)::INTEGER AS pos FROM h
""")
def top_links(spark, d):
    return px.top_links(_pages(spark, d), ["page_id"], 2, r"^/[a-z]+$")


# Links that stand outside the section and the navigation; neither operator may return them.
_OUTSIDE = """concat(%s, '<nav id="foot"><a href="/foot">f</a></nav><ul id="list"><li><a href="/list">l</a></ul>',
  '<div id="alphabetical"><a href="/div">d</a></div><a href="/bare">b</a>')""" % _MARKED


def _anchors_and_more(spark, d):
    marked = wide_table(spark, d, "pages", "page_id", "html").withColumn("html", F.expr(_OUTSIDE))
    return px.anchors(marked, ["page_id"])


@query(f"{_LINKS} SELECT page_id, pos, href FROM l")
def section_links(spark, d):
    return px.section_links(_anchors_and_more(spark, d)).select("page_id", "pos", "href")


@query(f"{_LINKS} SELECT page_id, pos, href FROM l")
def nav_links(spark, d):
    return px.nav_links(_anchors_and_more(spark, d)).select("page_id", "pos", "href")


@query("""
WITH h AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">the</a>', 1) AS hs FROM pages)
SELECT page_id, unnest(hs) AS href FROM h
""")
def labelled_links(spark, d):
    return px.labelled_links(_anchors(spark, d), "the").select("page_id", "href")


@query("""
WITH h AS (SELECT url, regexp_extract_all(html, '<a href="([^"]*)">the</a>', 1) AS hs FROM pages)
SELECT unnest(hs) AS url FROM h UNION ALL SELECT url FROM h WHERE len(hs) = 0
""")
def replace_by_label(spark, d):
    labelled = px.labelled_links(_anchors(spark, d, ["url"]), "the")
    return px.replace_by_label(_pages(spark, d).select("url"), labelled)


@query("""
WITH RECURSIVE c(node, depth) AS (
  SELECT DISTINCT l_partkey, 0 FROM lineitem WHERE l_returnflag = 'R'
  UNION SELECT node // 2, depth + 1 FROM c JOIN part ON p_partkey = node WHERE depth < 64 AND node > 0)
SELECT node, min(depth)::INTEGER AS depth FROM c GROUP BY node
""")
def closure(spark, d):
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'")
    edges = table(spark, d, "part").select(
        F.col("p_partkey").alias("src"), F.expr("p_partkey div 2").alias("dst")
    )
    return px.link_closure(returned.select(F.col("l_partkey").alias("node")), edges)


@query(f"""
{_LINKS} SELECT node, min(depth)::INTEGER AS depth FROM (
  SELECT url AS node, 0 AS depth FROM pages UNION ALL SELECT href, 1 FROM l WHERE href <> '') GROUP BY node
""")
def link_closure(spark, d):
    edges = px.extract_links(_pages(spark, d), ["url"]).where("href <> ''")
    edges = edges.select(F.col("url").alias("src"), F.col("href").alias("dst"))
    return px.link_closure(_pages(spark, d).select(F.col("url").alias("node")), edges)


@query(r"""
SELECT page_id, url AS canonical_url,
  regexp_replace(regexp_extract(url, '://([^/:?#]*)', 1), '^www\.', '') AS host,
  replace(replace(replace(replace(replace(trim(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g')),
    '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS title,
  nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS language
FROM pages
""")
def page_record(spark, d):
    pages = wide_table(spark, d, "pages", "page_id", "url", "html")
    return record_of(pages).select("page_id", "canonical_url", "host", "title", "language")


_RECIPE_PAGE = r"""concat('<html lang="en"><head><script type="application/ld+json">',
  CASE WHEN p_type = 'PROMO' THEN '[{"@type":"WebSite"},' WHEN p_type = 'SMALL' THEN '{"@graph":[' ELSE '' END,
  '{"@type":', CASE WHEN p_type = 'LARGE' THEN '["Recipe","NewsArticle"]' ELSE '"Recipe"' END,
  ',"name":"', p_name, '","recipeYield":"', p_size, '","prepTime":"PT', p_size, 'M","cookTime":"P0DT1H', p_size, 'M",',
  '"recipeCategory":["', p_type, '","', p_brand, '"],"author":{"name":"', p_brand, '"},',
  '"image":', CASE WHEN p_type = 'MEDIUM' THEN '[{"url":"i.png"}]' ELSE '"i.png"' END,
  ',"recipeIngredient":["', replace(p_name, ' ', '","'), '"],"aggregateRating":{"ratingValue":"4.5"},',
  '"recipeInstructions":', CASE WHEN p_type = 'ECONOMY' THEN '"mix\\nbake"'
     ELSE '[{"@type":"HowToStep","text":"mix"},{"text":"bake"}]' END, '}',
  CASE WHEN p_type = 'PROMO' THEN ']' WHEN p_type = 'SMALL' THEN ']}' ELSE '' END,
  '</script></head><body><h1>other</h1></body></html>')"""


@query("""
SELECT p_partkey, p_name AS title, p_size || ' servings' AS yields, p_size::BIGINT AS prep_time,
  p_size::BIGINT + 60 AS cook_time, p_size::BIGINT * 2 + 60 AS total_time,
  p_type || ',' || p_brand AS category, p_brand AS author, 'i.png' AS image, 4.5::DOUBLE AS ratings,
  replace(p_name, ' ', '|') AS ingredients, 'mix' || chr(10) || 'bake' AS instructions
FROM part
""")
def recipe_record(spark, d):
    parts = wide_table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    made = parts.select(
        "p_partkey",
        F.concat(F.lit("https://www.x.com/"), "p_partkey").alias("url"),
        F.expr(_RECIPE_PAGE).alias("html"),
    )
    return record_of(made).select(
        "p_partkey",
        "title",
        "yields",
        "prep_time",
        "cook_time",
        "total_time",
        "category",
        "author",
        "image",
        "ratings",
        F.array_join("ingredients", "|").alias("ingredients"),
        "instructions",
    )


#: Links of one listing page; groups of any size are dealt out to pages of so many keys.
_LISTED = 20_000


def _listing(rows, page, links):
    """Pages that list the links of their rows in order, after one that is no recipe.

    A page lists the keys of one block, so pages, not one cell, grow with the table.
    """
    ordered = F.array_sort(F.collect_list(F.struct("p_partkey", links.alias("link"))))
    anchors = F.transform(ordered, lambda r: F.concat(F.lit('<a href="'), r["link"], F.lit('">x</a>')))
    html = F.concat(F.lit('<p><a href="/about">About</a></p>'), F.array_join(anchors, ""))
    return rows.groupBy(page.alias("url")).agg(html.alias("html"))


def _parts_in_blocks(spark, d):
    block = F.expr(f"p_partkey div {_LISTED}").cast("string")
    return table(spark, d, "part").select(
        "p_partkey", "p_brand", (F.col("p_size") % 5).cast("string").alias("p_size"), block.alias("block")
    )


@query(f"""
SELECT 'https://www.allrecipes.com/cat/' || p_brand || '/' || p_partkey // {_LISTED} AS page, 'allrecipes' AS site,
  'https://www.allrecipes.com/recipe/' || p_partkey || '/a-b/' AS url,
  row_number() OVER (PARTITION BY p_brand, p_partkey // {_LISTED} ORDER BY p_partkey)::INTEGER AS pos
FROM part WHERE p_brand <> 'Brand#11'
""")
def discover_allrecipes(spark, d):
    """An A-Z page leads to the pages of each brand but one, which are linked outside its section."""
    parts = _parts_in_blocks(spark, d)
    recipe = F.concat(F.lit("https://www.allrecipes.com/recipe/"), "p_partkey", F.lit("/a-b/"))
    brand = F.concat_ws("/", F.lit("https://www.allrecipes.com/cat"), "p_brand", "block")
    link = F.concat(F.lit('<li><a href="'), brand, F.lit('">b</a>'))
    # One link for each block of keys.
    named = parts.select("p_brand", "block").distinct()
    inside, outside = (
        F.array_join(F.collect_list(F.when(which, link)), "")
        for which in (F.col("p_brand") != "Brand#11", F.col("p_brand") == "Brand#11")
    )
    az = named.agg(
        F.concat(F.lit('<ul id="alphabetical-list-1">'), inside, F.lit("</ul>"), outside).alias("html")
    ).select(F.lit(discover.ALLRECIPES_AZ[0]).alias("url"), "html")
    pages = _listing(parts, brand, recipe).unionByName(az)
    return discover.allrecipes_urls(pages).select("page", "site", "url", "pos")


@query(f"""
WITH b AS (SELECT *, p_partkey // {_LISTED} AS block FROM part),
l AS (
  SELECT 'https://www.food.com/size/' || p_size % 5 || '/' || block AS page, p_partkey FROM b
  UNION ALL SELECT 'https://www.food.com/brand/' || p_brand || '/' || block, p_partkey FROM b WHERE p_brand <> 'Brand#11')
SELECT page, 'fooddotcom' AS site, 'https://www.food.com/recipe/x-y-' || p_partkey AS url FROM l
""")
def discover_fooddotcom(spark, d):
    """Hubs of all sizes are a cycle of labelled links and lead by the label to the pages of their
    size; the navigation has the brands' pages, of which one brand's lead on to a size."""
    parts = _parts_in_blocks(spark, d)
    recipe = F.concat(F.lit("https://www.food.com/recipe/x-y-"), "p_partkey")
    size = F.concat_ws("/", F.lit("https://www.food.com/size"), "p_size", "block")
    brand = F.concat_ws("/", F.lit("https://www.food.com/brand"), "p_brand", "block")

    def more(to):
        return F.concat(F.lit('<a href="'), to, F.lit('">See Them All</a>'))

    hub = F.concat(F.lit("https://www.food.com/hub/"), "p_size")
    sizes = parts.groupBy("p_size").agg(F.array_join(F.collect_set(more(size)), "").alias("own"))
    following = Window.orderBy("p_size")
    least = sizes.agg(F.min("p_size")).first()[0]
    after = F.concat(
        F.lit("https://www.food.com/hub/"), F.coalesce(F.lead("p_size").over(following), F.lit(least))
    )
    hubs = sizes.select(hub.alias("url"), F.concat("own", more(after)).alias("html"))
    seed = f"https://www.food.com/hub/{least}"
    brands = _listing(parts, brand, recipe)
    led = F.col("url").contains("/brand/Brand#11/")
    brands = brands.withColumn("html", F.concat("html", F.when(led, more(F.lit(seed))).otherwise("")))
    link = F.concat(F.lit('<a href="/brand/'), "p_brand", F.lit("/"), "block", F.lit('">b</a>'))
    nav = parts.agg(
        F.concat(
            F.lit('<nav id="main-nav">'), F.array_join(F.collect_set(link), ""),
            F.lit('</nav><a href="/size/none">none</a>'),
        ).alias("html")
    ).select(F.lit(discover.FOODDOTCOM_NAV).alias("url"), "html")
    pages = _listing(parts, size, recipe).unionByName(brands).unionByName(hubs).unionByName(nav)
    return discover.fooddotcom_urls(pages, seeds=[seed]).select("page", "site", "url")
