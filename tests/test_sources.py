import json

import pytest

from phraseloom.sources import dom, pages, quoted, readers, services, sinks


def entries(spark, *items):
    lines = spark.createDataFrame([(i, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(items)], "_pos long, value string")
    return readers.parse_json_lines(lines)


def test_dictionary_senses(spark):
    e = {"word": "spill the beans", "lang": "English", "pos": "phrase", "senses": [{"glosses": ["plural of x"]}, {"glosses": ["", "  to   tell "], "tags": ["idiomatic", "x"], "examples": [{"text": ""}, "s", {"text": "t"}]}, {"glosses": [], "raw_glosses": ["raw one"]}]}
    df = entries(spark, e, e | {"lang": "French"}, e | {"word": "word"}, e | {"word": "Template:x y"}, "{broken")
    assert tuple(readers.line_counts(df).first()) == (5, 4)
    rows = sorted(readers.dictionary_senses(df).collect(), key=lambda r: r["sense_index"])
    assert [(r["sense_index"], r["meaning"], r["example"], r["idiom_hint"], r["tags"]) for r in rows] == [(1, "to tell", "s", 1, "idiomatic, x"), (2, "raw one", "", 0, "")]
    assert readers.dictionary_senses(df, strict=True).count() == 1


def test_slang_senses_ignore_language(spark):
    e = {"word": "hang  out", "lang": "French", "pos": "verb", "senses": [{"glosses": ["to relax"], "tags": ["slang"], "topics": ["x", "slang"]}, {"glosses": ["old"], "tags": ["slang", "alt-of"]}, {"glosses": ["plain"]}]}
    rows = readers.slang_senses(entries(spark, e)).collect()
    assert [(r["idiom"], r["meaning_en"], r["tags"], r["source_url"]) for r in rows] == [("hang out", "to relax", "slang,x", "https://en.wiktionary.org/wiki/hang%20out")]


def test_tables_and_lists(spark, tmp_path):
    df = spark.createDataFrame([("b a", "x, \"y\"\nz"), ("A  b", None)], "idiom_canonical string, m string")
    sinks.publish({"t": df}, str(tmp_path))
    for suffix in ("parquet", "csv"):
        back = readers.read_any(spark, f"{tmp_path}/t.{suffix}")
        assert sorted((r[0], r[1]) for r in back.collect()) == sorted((r[0], r[1]) for r in df.collect())
    sinks.write_list(df, "idiom_canonical", f"{tmp_path}/l.txt")
    assert [r[0] for r in readers.read_inventory(spark, f"{tmp_path}/l.txt").collect()] == ["a b", "b a"]
    assert readers.first_existing(spark, f"{tmp_path}/none", f"{tmp_path}/t.csv").endswith("t.csv")
    with pytest.raises(FileNotFoundError):
        readers.first_existing(spark, f"{tmp_path}/none")
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.xlsx")
    rounds = readers.read_rounds(spark, [f"{tmp_path}/t.parquet", f"{tmp_path}/t.csv"])
    assert {r["source_file"] for r in rounds.collect()} == {"t.parquet", "t.csv"}
    stage = f"{tmp_path}/stage"
    assert sinks.checkpoint_stage(df, stage).count() == sinks.checkpoint_stage(df.limit(0), stage).count() == 2


def test_report_and_markdown(spark, tmp_path):
    sinks.write_report(spark.createDataFrame([(1, "x")], "a int, b string"), f"{tmp_path}/r")
    assert json.loads(spark.read.text(f"{tmp_path}/r").first()[0]) == {"a": 1, "b": "x"}
    long = spark.createDataFrame([("core", "rows", "3")], "section string, metric string, value string")
    assert [r[0] for r in sinks.markdown(long, "T").collect()] == ["# T", "\n## core\n\n| metric | value |\n|---|---|", "| rows | 3 |"]


HTML = '<html><head><title>x</title></head><body><a class="big word" href="/define.php?term=cut+slack">Cut  slack</a><div class="meaning">to <b>ease</b> &amp; relax</div><div class="example">He cut me slack.</div><a href="/define.php?term=hang%20out">h</a><a href="/define.php?x=1&amp;term=hang%20out">h</a><a href="/define.php?term=single">s</a><a href="/other?term=no+link">n</a><p>by me</p></body></html>'


def test_pages(spark):
    df = spark.createDataFrame([(1, "cut slack", HTML), (2, "none at all", None)], "page_id long, term string, html string")
    assert [tuple(r) for r in pages.class_entries(df).collect()] == [(1, 0, "Cut slack", "to ease & relax", "He cut me slack.")]
    assert [tuple(r) for r in pages.class_entries(df, requested="term").collect()] == [(1, 0, "cut slack", "to ease & relax", "He cut me slack.")]
    assert [r["term"] for r in pages.links(df).collect()] == ["cut slack", "hang out"]  # of the path, phrases only
    assert [r["term"] for r in pages.links(df, path="").collect()] == ["cut slack", "hang out", "no link"]
    assert [r["term"] for r in pages.links(df, own="term", path="").collect()] == ["hang out", "no link"]


def test_page_lines(spark):
    html = "<p>Intro</p><p>Cut Slack</p><p>Share definition</p><p>to ease</p><p>He did.</p><p>Again.</p><p>by me</p><p>more</p><p>cut slack</p><p>a gun</p><p>by you</p><p>cut slack</p><p>to let go</p><p>Get the mug</p>"
    df = spark.createDataFrame([(1, "cut slack", html), (2, "cut slack", "<p>cut slack</p><p>by me</p>"), (3, "slack", "<p>slack</p><p>m</p>"), (4, "cut slack", "")], "page_id long, term string, html string")
    assert [tuple(r) for r in pages.text_entries(df).orderBy("page_id", "at").collect()] == [(1, 0, "cut slack", "to ease", "He did."), (1, 2, "cut slack", "to let go", "")]
    both = df.union(spark.createDataFrame([(5, "cut slack", HTML)], df.schema))
    assert sorted((r["page_id"], r["meaning"]) for r in pages.page_entries(both).collect()) == [(1, "to ease"), (1, "to let go"), (5, "to ease & relax")]


PARSES = [
    ('<div class="meaning">a <div>b</div> c</div>', ".meaning", ["a b c"]),
    ('<p class="word-count">no</p><p class="word">yes</p><p class=word>plain</p>', ".word", ["yes", "plain"]),
    ("<h1>one</h1><H2 id=x>two</H2><h3>three</h3>", "h1, h2", ["one", "two"]),
    ('<a class="x word y">a</a><b class="word">b</b>', "a.word", ["a"]),
    ("<div class=m>caf&eacute; &mdash; it&#8217;s &#x41;&lt;b&gt;</div>", ".m", ["café — it’s A<b>"]),
    ("<div class=m>open <i>never closed <p>more", ".m", ["open never closed more"]),
    ("<div class=m>a<br>b<img src=x>c</div>d", ".m", ["a b c"]),
    ("</div></p><div class=m>x</span>y</div>", ".m", ["x y"]),
    ("<div class=m>a<script>var b = '</p>';</script><style>p{}</style><!-- c -->d</div>", ".m", ["a d"]),
    ("<div class=m><div class=m>in</div>out</div>", ".m", ["in out", "in"]),
    ("", ".m", []),
]


@pytest.mark.parametrize(("html", "selector", "texts"), PARSES)
def test_elements_by_tag_and_class(html, selector, texts):
    assert [" ".join(t) for t in dom.parse(html, [dom.selector(selector)]).texts[0]] == texts


def test_selectors_that_are_none():
    with pytest.raises(ValueError):
        dom.selector("div > p")


QUOTED = [
    ["a,b", "1,x"],
    ['"a","b"', '1,"two\nlines"', '2,"a ""quoted"" word"'],
    ["a,b", '1,"x\n\ny"', "", '2,"comma, and\r\nCRLF"', '3,5" pipe'],
    ["\ufeffa,b", '"",""', "1,", ',"last\n"'],
    ["a,b", '1,"' + "\n".join(f"line {i}" for i in range(400)) + '"', *[f"{i},v{i}" for i in range(2, 300)], '300,"' + '""\n' * 50 + '"'],
]


@pytest.mark.parametrize("broadcast", [500_000, 0])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("rows", QUOTED)
def test_quoted_csv_by_blocks_is_what_the_whole_file_gives(spark, tmp_path, rows, end, broadcast):
    text = end.join(rows) + end
    (tmp_path / "f.csv").write_bytes(text.encode())
    path = f"{tmp_path.as_uri()}/f.csv"
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "").csv(path)
    want = sorted(repr(tuple(r)) for r in whole.collect())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 64)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        got = quoted.read_quoted_csv(spark, path, broadcast_rows=broadcast)
        assert got.columns == [c.lstrip("\ufeff") for c in whole.columns]
        assert sorted(repr(tuple(r)) for r in got.collect()) == want
        if len(text) > 1000:
            assert spark.read.text(path).rdd.getNumPartitions() > 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_services():
    class Fake:
        def __init__(self):
            self.left = ["running", "completed"]

        def status(self, batch_id):
            return self.left.pop(0) if len(self.left) > 1 else self.left[0]

        def download(self, batch_id, target):
            return target

        def submit(self, f, m):
            return "b1"

    fake = Fake()
    assert services.submit(fake, "f", {"k": "v"}) == {"batch_id": "b1", "k": "v"}
    with pytest.raises(RuntimeError):
        services.download(fake, "b", "t")
    assert services.poll(fake, "b", 1, 5, sleep=lambda s: None) == "completed" and services.download(fake, "b", "t") == "t"


def test_work_goes_on_after_a_kill_at_any_batch(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from phraseloom.streaming import resume

    folder, schema = tmp_path.as_uri(), "i long, t string"
    rows = spark.range(40).selectExpr("id AS i", "concat('t', id) AS t").coalesce(1)
    resume.stage_rows(rows, f"{folder}/items", 8)
    seen = []

    def step(df):
        seen.append(df.count())
        return df.selectExpr("i", "upper(t) AS t")

    def die_at(n):
        def after(number):
            if number == n:
                raise InterruptedError

        return after

    work = lambda after: resume.work_off(spark, f"{folder}/items", schema, step, f"{folder}/done", f"{folder}/marks", 1, after)
    for n in (0, 2, 3):
        with pytest.raises(StreamingQueryException):
            work(die_at(n))
    work(None)
    got = resume.worked_off(spark, f"{folder}/done", schema)
    assert sorted((r["i"], r["t"]) for r in got.collect()) == [(i, f"T{i}") for i in range(40)] and got.select("batch").distinct().count() == 5
    assert len(seen) == 5 + 3  # the three batches that were under way once more, no other
    work(None)
    assert got.count() == 40 and len(seen) == 8


def test_stream_of_lines(spark, tmp_path):
    from phraseloom.streaming import lines

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("JOHN: please cut some slack today\n42\nshort\nplease cut some slack again\n")
    query = lines.phrase_counts(lines.read_line_stream(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("phrases").start()
    try:
        query.processAllAvailable()
        got = {r["phrase"]: r["n"] for r in spark.table("phrases").collect()}
    finally:
        query.stop()
    assert got["cut some slack"] == 2


def test_one_row_group_of_narrow_rows_is_dealt_out(spark, tmp_path):
    """Pages and answers that queries make of a narrow file are parsed by all cores, whatever its row groups are."""
    from pyspark.sql import functions as F

    from phraseloom import queries, queries_io

    spark.range(1000).selectExpr("id AS p_partkey", "concat('blow ', id, ' off') AS p_name", "'t' AS p_type", "'b' AS p_brand", "1 AS p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(1000).selectExpr("id AS event_id", "'click' AS event_type").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    for rows in (queries_io.made_pages(spark, str(tmp_path)), queries._results(spark, str(tmp_path))):
        held = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 1000 and len(held) == cores and max(held) < 2 * 1000 / cores
    parts = readers.dealt(spark.range(1000).coalesce(1), 10)
    held = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 1000 and len(held) == 100 and max(held) <= 20
