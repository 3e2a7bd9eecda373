"""Corpus batch, scraped batch, exports, sources and sinks end to end."""

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from larder.plans import corpus as cx
from larder.plans import scraped as sx
from larder.plans.export import export
from larder.schemas import DISH, RAW_CORPUS, SCRAPED, SCRAPED_DISH_COLUMNS, UNIQUE_INGREDIENTS
from larder.sinks import tables as kx
from larder.sources import corpus as rx
from larder.sources import messages as mx
from larder.sources import tables as tx

HEADER = ["", "title", "ingredients", "directions", "link", "source", "NER"]
RAW = [
    ["Pie", "['1 cup\\tflour', \"it's\"]", '["mix", "bake\\nnow"]', "www.a.com/pie", "Gathered", "['salt', 'Apple 2']"],
    ["", "[]", "[]", "http://B.com:80/x/y", "Gathered", "[]"],
    ["Bad", "['broken'", "[]", "https://c.com/1", "c", "[]"],
    ["Cake, \"nice\"\nand big", "['egg']", "['x']", "https://c.com/2", "c", "['SALT']"],
    ["Old", "['a']", "['b']", "https://www.cookbooks.com/1", "www.cookbooks.com", "['z']"],
    ["Epi", "['a']", "['b']", "https://www.epicurious.com/recipes/MEMBER/9", "e", "['z']"],
    ["Plus", "['a']", "['b']", "https://d.com/Recipes-Plus/9", "d", "['z']"],
    ["No source", "['a']", r"['caf\xe9']", "https://d.com/3", "", "['salt ']"],
    ["Second c", "['a']", "['b']", "https://c.com/3", "c", "['egg']"],
]


def write_raw(directory, spec, rows):
    os.makedirs(directory, exist_ok=True)
    with open(f"{directory}/raw_dataset_{spec}.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(HEADER)
        out.writerows([i, *r] for i, r in enumerate(rows))


@pytest.fixture
def folders(tmp_path):
    raw = str(tmp_path / "raw")
    write_raw(raw, "recipeNLG", RAW)
    write_raw(raw, "unknown", RAW[:1])
    (tmp_path / "raw" / "notes.txt").write_text("x")
    return raw, str(tmp_path / "processed"), str(tmp_path / "output")


def test_batch_run(spark, folders):
    raw, processed, output = folders
    result = cx.run_batch(spark, raw, processed, output, small_rows=2)
    assert (result.processed, result.skipped) == (["recipeNLG"], ["unknown"])
    assert [(r["n"], r["url"]) for r in result.rejects.collect()] == [(2, "https://c.com/1")]
    rows = result.master.orderBy("master_id").collect()
    assert [r["dish_id"] for r in rows] == [1, 3, 0, 8, 7]
    assert [r["source"] for r in rows] == ["b.com", "c", "www.a.com", "c", None]
    pie = rows[2]
    assert (pie["uid"], pie["dish"], pie["url"], pie["img"]) == ("pie_0", "Pie", "https://www.a.com/pie", "NA")
    assert json.loads(pie["ingredients"]) == {"ingredients": ["Apple", "salt"]}
    assert json.loads(pie["quantities"]) == {"quantities": ["1 cupflour", "it's"]}
    assert json.loads(pie["directions"]) == {"directions": ["mix", "bakenow"]}
    assert (rows[0]["dish"], rows[0]["uid"]) == ("missing", "missing_1")
    assert (rows[1]["dish"], rows[1]["uid"]) == ('Cake, "nice"and big', "cakeniceandbig_3")
    assert json.loads(rows[4]["directions"]) == {"directions": ["café"]}
    kinds = {f.name: f.dataType for f in result.master.schema}
    assert all(kinds[f.name] == f.dataType for f in DISH)

    words = spark.read.parquet(f"{output}/unique_ingredients")
    assert words.columns == UNIQUE_INGREDIENTS.fieldNames()
    got = {(r[0], r[1], r[2]) for r in words.collect()}
    assert got == {(0, None, 0), (1, "salt", 3), (2, "apple", 1), (3, "egg", 1)}
    small = spark.read.parquet(f"{output}/unique_ingredients_small")
    assert {(r[0], r[1], r[2]) for r in small.collect()} == {(0, None, 0), (1, "salt", 1)}
    assert spark.read.parquet(f"{output}/dish_recipes_small").count() == 2


def test_batch_run_takes_only_new_datasets(spark, folders):
    raw, processed, output = folders
    both = {"recipeNLG": cx.recipe_nlg, "second": cx.recipe_nlg}
    cx.run_batch(spark, raw, processed, output, processors=both)
    write_raw(raw, "second", RAW[:1])
    again = cx.run_batch(spark, raw, processed, output, processors=both)
    assert (again.processed, again.skipped) == (["second"], ["unknown"])
    assert again.master.count() == 6
    assert tx.read_processed(spark, processed, "second").count() == 1
    redone = cx.run_batch(spark, raw, processed, output, reprocess=True, processors=both)
    assert redone.processed == ["recipeNLG", "second"]
    assert redone.master.count() == 6


def _garble(folder):
    """Replace the data files of a folder by what no reader can read."""
    for root, _, names in os.walk(folder):
        for name in names:
            with open(os.path.join(root, name), "w") as f:
                f.write("garbage" if name.endswith(".parquet") else "")


def _vocabulary(spark, output):
    return {tuple(r) for r in spark.read.parquet(f"{output}/unique_ingredients").collect()}


def test_a_new_dataset_alone_is_read_and_the_vocabulary_is_the_whole_one(spark, tmp_path):
    raw, processed, output, scratch = (str(tmp_path / x) for x in ("raw", "processed", "output", "scratch"))
    three = dict.fromkeys(("a", "b", "c"), cx.recipe_nlg)
    # The third dataset has older words, new ones, and rows past those of the small extract.
    rows = {"a": RAW[:1], "b": RAW, "c": [RAW[8], [*RAW[0][:5], "['Zest', 'salt']"]]}
    write_raw(raw, "a", rows["a"])
    write_raw(raw, "b", rows["b"])
    cx.run_batch(spark, raw, processed, output, processors=three, small_rows=3)
    write_raw(raw, "c", rows["c"])
    for spec in ("a", "b"):
        _garble(f"{processed}/spec={spec}")
        _garble(f"{raw}/raw_dataset_{spec}.csv")
    added = cx.run_batch(spark, raw, processed, output, processors=three, small_rows=3)
    assert added.processed == ["c"]
    for spec in ("a", "b"):
        write_raw(raw, spec, rows[spec])
    whole = cx.run_batch(spark, raw, f"{scratch}/p", f"{scratch}/o", processors=three, small_rows=3)
    assert _vocabulary(spark, output) == _vocabulary(spark, f"{scratch}/o")
    assert sorted(added.master.collect()) == sorted(whole.master.collect())
    assert sorted(r["master_id"] for r in added.master.collect()) == list(range(8))
    for name in ("dish_recipes_small", "unique_ingredients_small"):
        one, other = (spark.read.parquet(f"{o}/{name}").collect() for o in (output, f"{scratch}/o"))
        assert sorted(one) == sorted(other)


def test_a_dataset_before_the_others_moves_them(spark, tmp_path):
    raw, processed, output, scratch = (str(tmp_path / x) for x in ("raw", "processed", "output", "scratch"))
    two = dict.fromkeys(("a", "b"), cx.recipe_nlg)
    write_raw(raw, "b", RAW)
    cx.run_batch(spark, raw, processed, output, processors=two, small_rows=4)
    write_raw(raw, "a", RAW[7:])
    added = cx.run_batch(spark, raw, processed, output, processors=two, small_rows=4)
    whole = cx.run_batch(spark, raw, f"{scratch}/p", f"{scratch}/o", processors=two, small_rows=4)
    assert sorted(added.master.collect()) == sorted(whole.master.collect())
    assert _vocabulary(spark, output) == _vocabulary(spark, f"{scratch}/o")
    assert spark.read.parquet(f"{output}/dish_recipes_small").count() == 4


def test_names_of_digits_and_datasets_without_a_good_row(spark, tmp_path):
    raw, processed, output = (str(tmp_path / x) for x in ("raw", "processed", "output"))
    bad = [RAW[2]]
    write_raw(raw, "007", RAW)
    write_raw(raw, "none", bad)
    both = {"007": cx.recipe_nlg, "none": cx.recipe_nlg}
    first = cx.run_batch(spark, raw, processed, output, processors=both)
    assert first.processed == ["007", "none"]
    assert {r["spec"] for r in first.master.collect()} == {"007"}
    assert {r["spec"] for r in first.rejects.collect()} == {"007", "none"}
    assert cx.run_batch(spark, raw, processed, output, processors=both).processed == []
    write_raw(raw, "007", bad)
    redone = cx.run_batch(spark, raw, processed, output, reprocess=True, processors=both)
    assert redone.master.count() == 0 and redone.rejects.count() == 2


def test_process_in_one_call(spark, folders):
    landed = rx.land_raw(spark, rx.raw_path(folders[0], "recipeNLG"))
    dishes = cx.process_recipe_nlg(landed, f"{folders[2]}/rejects")
    assert dishes.columns == DISH.fieldNames()
    assert [r["dish_id"] for r in dishes.collect()] == [1, 3, 0, 8, 7]


@pytest.mark.parametrize("files", [1, 5])
def test_landed_positions_follow_the_files(spark, tmp_path, files):
    source = spark.range(0, 5000, 1, files).select(F.col("id").alias("row_label"), F.lit("t").alias("title"))
    path = str(tmp_path / "raw_dataset_x.csv")
    source.write.option("header", True).csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        landed = rx.land_raw(spark, path, RAW_CORPUS, multi_line=False)
        assert landed.where("n <> row_label").count() == 0 and landed.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("split", [97, 700, 20_000])
def test_a_large_file_with_breaks_in_fields_is_read_by_many_tasks(spark, tmp_path, split):
    """Breaks, doubled and lone quotes and empty lines, at and around the ends of splits."""
    texts = ["plain", 'say ""', "two\nlines", '"', "\n\n", 'a ""quoted"" \n "x"', "", "tail\n", "é\n" * 40, ",\n,"]
    rows = [[i, texts[i % 10], "['x']", texts[(i * 7) % 10], f"l{i}", "s", "[]"] for i in range(400)]
    path = str(tmp_path / "raw_dataset_x.csv")
    os.makedirs(path)
    for part in range(2):
        with open(f"{path}/part-{part}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(HEADER)
            for at, row in enumerate(rows[part * 200 : part * 200 + 200]):
                out.writerow(row)
                if at % 50 == 0:
                    f.write("\n")
    conf = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        many = rx.land_raw(spark, path, RAW_CORPUS, large=0)
        assert rx.quoted_records(spark, path).select("_file", "_block").distinct().count() > (2 if split < 20_000 else 1)
        got = sorted(tuple(r) for r in many.fillna("").collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    one = rx.land_raw(spark, path, RAW_CORPUS)
    assert got == sorted(tuple(r) for r in one.fillna("").collect()) and len(got) == 400
    assert [r[-1] for r in sorted(got, key=lambda r: r[-1])] == list(range(400))
    assert all(r[0] == r[-1] and r[1] == rows[r[0]][1] for r in got)


def test_parquet_positions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 7).write.parquet(path)
    out = rx.parquet_positions(spark, path)
    assert out.where("idx <> id").count() == 0 and out.count() == 1000


def test_export(spark, tmp_path, folders):
    landed = rx.land_raw(spark, rx.raw_path(folders[0], "recipeNLG"))
    out = str(tmp_path / "export")
    counts = export(cx.placed_recipe_nlg(landed, f"{out}-rejects"), out, test_rows=2)
    assert {(r["source"], r["count"]) for r in counts.collect()} == {("c", 2), ("b.com", 1), ("www.a.com", 1)}
    listed = spark.read.option("header", True).csv(f"{out}/url_dataset").collect()
    assert [r["uid"] for r in listed] == ["missing_1", "cakeniceandbig_3", "pie_0", "secondc_8", "nosource_7"]
    short = spark.read.option("header", True).csv(f"{out}/url_test").collect()
    assert [r["uid"] for r in short] == ["missing_1", "cakeniceandbig_3"]
    docs = spark.read.json(f"{out}/json").collect()
    names = {r["json_filename"]: json.loads(r["doc"]) for r in docs}
    assert names["0_www_a_com.json"]["uid"] == "pie_0" and "7_.json" in names


def test_sinks(spark, tmp_path):
    df = spark.range(10).select(F.col("id").alias("idx"), F.lit("é").alias("t"))
    kx.write_shards(df, str(tmp_path / "s"), "idx", 4)
    assert sorted(p for p in os.listdir(tmp_path / "s") if p.startswith("shard")) == ["shard=1", "shard=2", "shard=3"]
    kx.write_head(df, str(tmp_path / "h"), "idx", 3)
    assert sorted(r["idx"] for r in spark.read.parquet(str(tmp_path / "h")).collect()) == [0, 1, 2]
    kx.write_messages(df, str(tmp_path / "m"), "idx")
    kx.write_messages(df, str(tmp_path / "m"), "idx")
    assert spark.read.json(str(tmp_path / "m")).count() == 20


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"uid": "u",\n "ingredients": ["x"]}')
    (tmp_path / "b.txt").write_text("no")
    objects = mx.read_json_objects(spark, str(tmp_path)).collect()
    assert [json.loads(r["record"].toJson())["uid"] for r in objects] == ["u"]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "x.json").write_text('{"title": "t"}\n{"uid": "u", "total_time": 5}\n')
    records = mx.read_records(spark, str(tmp_path / "r")).orderBy("uid").collect()
    assert [(r["title"], r["total_time"]) for r in records] == [("t", None), (None, "5")]
    a = str(tmp_path / "pa")
    b = str(tmp_path / "pb")
    spark.range(2).write.parquet(a)
    spark.range(1).withColumn("x", F.lit(1)).write.parquet(b)
    assert tx.read_all(spark, [a, b]).columns == ["id", "x"]
    pages = spark.createDataFrame([("u", 1, "old"), ("u", 2, "new"), ("v", 1, "v")], "url string, at long, html string")
    assert {r["html"] for r in tx.latest_pages(pages, "at").collect()} == {"new", "v"}


def test_clean_scraped(spark):
    rows = [
        {"title": "A\tb", "category": "x,y", "cuisine": "", "total_time": "75", "ingredient_tags": ["b1", "A"],
         "ingredients": ["1 é"], "instructions_list": ["m\n"], "ratings": "4.5", "canonical_url": "u", "host": "h"},
        {"title": "", "category": "", "total_time": "45 min", "prep_time": "7.5", "ingredient_tags": []},
    ]
    lines = [json.dumps(r) for r in rows]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "n long, t string")
    records = df.select("n", F.from_json("t", SCRAPED).alias("r")).select("n", "r.*")
    good, bad = cx.split_rejects(sx.clean_scraped(records), "bad_time")
    r = good.first()
    assert good.columns == SCRAPED_DISH_COLUMNS
    assert (r["uid"], r["dish"], r["total_time"], r["ratings"]) == ("ab_0", "Ab", 75, 4.5)
    assert json.loads(r["category"]) == {"category": ["x", "y"]}
    assert json.loads(r["cuisine"]) == {"cuisine": ["missing"]}
    assert json.loads(r["ingredients"]) == {"ingredients": ["A", "b"]}
    assert json.loads(r["directions"]) == {"directions": ["m"]}
    assert [x["uid"] for x in bad.collect()] == ["missing_1"]
    legacy = sx.clean_scraped(records, legacy_keys=True).orderBy("dish_id").first()
    assert json.loads(legacy["cuisine"]) == {"category": ["missing"]}


def test_files_of_json_objects_share_a_folder(spark, tmp_path):
    """A folder for each of them made the listing and the write grow out of hand."""
    import catalogue.events as ev

    suppliers = [(i, f"s {i} é", i / 4) for i in range(40)] + [(None, "no key", None)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_acctbal double").write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    found = ev.json_objects(spark, str(tmp_path))
    assert len(found.inputFiles()) == 41
    assert len({os.path.dirname(f) for f in found.inputFiles()}) == 1
    assert sorted(map(tuple, found.collect()), key=str) == sorted(suppliers, key=str)
