"""Registered queries of sources, sinks, schema and publication operators: what is written is read back, and SQL answers from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from phraseloom.functions import predicates as P
from phraseloom.functions import text as T
from phraseloom.operators import dedup as D
from phraseloom.operators import enrich as E
from phraseloom.operators import joins as J
from phraseloom.operators import publish as Pub
from phraseloom.operators import schema as Sch
from phraseloom.operators import stats as St
from phraseloom.operators import windows as W
from phraseloom.plans import pipelines as Plan
from phraseloom.queries import CORE_SQL, ENRICHED_SQL, IDIOMS_SQL, LINES_SQL, enriched, idioms, lines, query, s_count, s_key, s_norm, s_safe, table
from phraseloom.sources import pages as Pages
from phraseloom.sources import readers as R
from phraseloom.sources import services
from phraseloom.sources import sinks as Out
from phraseloom.sources.scratch import scratch_folder
from phraseloom.streaming import resume as Resume

EMPTY_IS_NULL = "SELECT _pos::VARCHAR AS _pos, nullif(idiom, '') AS idiom, nullif(meaning, '') AS meaning, nullif(example, '') AS example, nullif(tags, '') AS tags FROM idioms"


# --- sources and sinks ---------------------------------------------------------------------------------------------------------------
@query("q_csv_round_trip", EMPTY_IS_NULL, idioms=IDIOMS_SQL)
def _csv(spark, d):
    """Written with a byte-order mark before the header's first name; only '' is null (SRC3, SNK1)."""
    path = scratch_folder(spark, "csv")
    rows = idioms(spark, d).select("_pos", "idiom", "meaning", "example", "tags")
    Out.write_csv(rows.withColumnRenamed("_pos", "﻿_pos"), path)
    return R.read_csv(spark, path)


@query("q_csv_quoted_breaks", "SELECT doc_id, CASE WHEN text <> '' THEN text END AS text, CASE WHEN lang <> '' THEN lang END AS lang FROM documents")
def _csv_breaks(spark, d):
    """Whole texts with line breaks, quotes and separators, read by blocks of the files (SRC3)."""
    path = scratch_folder(spark, "csv-breaks")
    Out.write_csv(table(spark, d, "documents").select(F.col("doc_id").alias("﻿doc_id"), "text", "lang"), path)
    return R.read_csv(spark, path, "doc_id long, text string, lang string")


@query("q_parquet_round_trip", "SELECT _pos, idiom, example, size FROM idioms", idioms=IDIOMS_SQL)
def _parquet(spark, d):
    path = f"{scratch_folder(spark, 'parquet')}.parquet"
    Out.write_parquet(idioms(spark, d).select("_pos", "idiom", "example", "size"), path)
    return R.read_parquet(spark, path)


@query("q_any_by_suffix", "SELECT 'csv' AS kind, count(*) AS n, count(nullif(tags, '')) AS tagged FROM idioms UNION ALL SELECT 'parquet', count(*), count(tags) FROM idioms UNION ALL SELECT 'other', 0, 0", idioms=IDIOMS_SQL)
def _by_suffix(spark, d):
    """CSV and Parquet by their suffix, any other is an error (SRC6)."""
    folder, rows = scratch_folder(spark, "any"), idioms(spark, d).select("idiom", "tags")
    Out.publish({"table": rows}, folder)
    found = [R.read_any(spark, f"{folder}/table.{kind}").agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"), F.count("tags").alias("tagged")) for kind in ("csv", "parquet")]
    try:
        R.read_any(spark, f"{folder}/table.xls")
    except ValueError:
        found.append(spark.sql("SELECT 'other' AS kind, 0L AS n, 0L AS tagged"))
    return reduce(lambda a, b: a.unionByName(b), found)


@query("q_both_formats", "SELECT kind, _pos, idiom FROM (SELECT _pos, idiom FROM idioms), (SELECT unnest(['csv', 'json']) AS kind)", idioms=IDIOMS_SQL)
def _both(spark, d):
    """The same rows as CSV and as JSON lines (SNK3, SRC1)."""
    folder = scratch_folder(spark, "both")
    Out.write_both(idioms(spark, d).select("_pos", "idiom"), f"{folder}/rows.csv", f"{folder}/rows.jsonl")
    from_csv = R.read_csv(spark, f"{folder}/rows.csv", "_pos long, idiom string").select(F.lit("csv").alias("kind"), "_pos", "idiom")
    entries = R.read_json_lines(spark, f"{folder}/rows.jsonl", "_pos long, idiom string").where("parsed")
    return from_csv.unionByName(entries.select(F.lit("json").alias("kind"), "entry._pos", "entry.idiom"))


@query("q_json_lines_file", "SELECT count(*) AS lines, count(*) FILTER (event_id % 9 <> 0) AS parsed FROM events")
def _json_file(spark, d):
    """Blank lines are skipped and broken ones counted (SRC1, SRC2)."""
    path = scratch_folder(spark, "jsonl")
    value = F.when(F.col("event_id") % 9 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("event_id")))
    table(spark, d, "events").select(F.explode(F.array(value, F.lit("  "))).alias("value")).write.text(path)
    return R.line_counts(R.read_json_lines(spark, path, "event_id long"))


#: Written lines as a reader finds them: a carriage return ends a line, before a line feed it is part of that line's end.
FILE_LINES = "SELECT unnest(string_split(regexp_replace(text, '\\r$', ''), chr(13))) AS text FROM lines"


@query("q_text_lines", "SELECT text, count(*) AS n FROM found GROUP BY 1", lines=LINES_SQL, found=FILE_LINES)
def _text_lines(spark, d):
    """Lines written as gz text and read again (SRC5)."""
    path = f"{scratch_folder(spark, 'lines')}/"
    lines(spark, d).select("text").write.option("compression", "gzip").text(path)
    return R.read_lines(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query("q_line_numbers", "SELECT count(*) AS lines, count(*) AS positions, 0 AS gaps FROM found", lines=LINES_SQL, found=FILE_LINES)
def _line_numbers(spark, d):
    """Every line has a row number of its own in its file, from 0 without gaps (SRC5)."""
    path = f"{scratch_folder(spark, 'numbers')}/"
    lines(spark, d).select("text").write.text(path)
    files = R.read_lines(spark, path).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row").alias("rows"), F.min("row").alias("least"), F.max("row").alias("most"))
    gap = F.col("most") + 1 - F.col("n") + F.abs("least")
    return files.agg(F.sum("n").alias("lines"), F.sum("rows").alias("positions"), F.sum(gap).alias("gaps"))


@query("q_first_existing", "SELECT 'enriched' AS stage, count(*) AS n FROM part")
def _fallback(spark, d):
    """The first stage that exists of verified, validated, enriched and source (SRC7, SRC8)."""
    folder = scratch_folder(spark, "stages")
    for stage in ("enriched", "source"):
        Out.write_parquet(table(spark, d, "part").select("p_partkey", F.lit(stage).alias("stage")), f"{folder}/{stage}.parquet")
    path = R.first_existing(spark, *[f"{folder}/{stage}.parquet" for stage in ("verified", "validated", "enriched", "source")])
    return R.read_any(spark, path).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


@query("q_round_files", "SELECT source_file, count(*) AS n FROM (SELECT CASE WHEN p_partkey % 3 = 0 THEN 'round_1.parquet' ELSE 'round_2.csv' END AS source_file FROM part) GROUP BY 1")
def _rounds(spark, d):
    """Round files with their name; the one without the column is left out (SRC9)."""
    folder, part = scratch_folder(spark, "rounds"), table(spark, d, "part").select("p_partkey", F.col("p_name").alias("idiom_canonical"))
    Out.write_parquet(part.where("p_partkey % 3 = 0"), f"{folder}/round_1.parquet")
    Out.write_csv(part.where("p_partkey % 3 <> 0"), f"{folder}/round_2.csv")
    Out.write_parquet(part.select("p_partkey"), f"{folder}/round_3.parquet")
    return R.read_rounds(spark, [f"{folder}/{x}" for x in ("round_1.parquet", "round_2.csv", "round_3.parquet")]).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


@query("q_first_round_wins", "SELECT idiom_canonical, min(r) AS round FROM (SELECT lower(p_name) AS idiom_canonical, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 2 END AS r FROM part) GROUP BY 1")
def _first_round(spark, d):
    """Accepted rounds merged, the first file's row of an idiom winning (SRC9, DD24)."""
    part = table(spark, d, "part").select(F.lower("p_name").alias("idiom_canonical"), F.when(F.col("p_partkey") % 3 == 0, 1).otherwise(2).alias("round"), F.col("p_partkey").alias("_pos"))
    rounds = [part.where(F.col("round") == n).withColumn("source_dataset", F.lit(str(n))) for n in (1, 2)]
    return Pub.merge_branches(*rounds, keys=["idiom_canonical"], priority=["1", "2"]).select("idiom_canonical", "round")


@query("q_inventory_file", f"SELECT kind, idiom_canonical FROM (SELECT DISTINCT {s_key('p_name')} AS idiom_canonical FROM part), (SELECT unnest(['csv', 'parquet', 'txt']) AS kind)")
def _inventory_file(spark, d):
    """An inventory written as text, CSV and Parquet and loaded from each (SRC11, SNK6)."""
    folder, part = scratch_folder(spark, "inventory"), table(spark, d, "part").select(F.col("p_name").alias("idiom_canonical"))
    Out.write_list(part, "idiom_canonical", f"{folder}/list.txt")
    Out.publish({"list": part}, folder)
    kinds = [R.read_inventory(spark, f"{folder}/list.{kind}").select(F.lit(kind).alias("kind"), "idiom_canonical") for kind in ("txt", "csv", "parquet")]
    return reduce(lambda a, b: a.unionByName(b), kinds)


@query("q_seeds", f"SELECT DISTINCT term FROM (SELECT {s_key('p_name')} AS term FROM part UNION ALL SELECT {s_key('brand')} FROM items) WHERE {s_count('term')} BETWEEN 2 AND 8 AND regexp_matches(term, '[a-zA-Z]') AND NOT regexp_matches(term, '[<>\\[\\]{{}}_=+*/\\\\|]')")
def _seeds(spark, d):
    """Seed terms out of lines: normalised phrases of two to eight words, distinct (SRC15)."""
    listed = table(spark, d, "part").select(F.col("p_name").alias("term")).unionByName(table(spark, d, "items").select(F.col("brand").alias("term")))
    return R.seed_terms(listed)


@query("q_header_peek", "SELECT 'idiom' AS name UNION ALL SELECT 'meaning' UNION ALL SELECT 'rows <= 3'")
def _peek(spark, d):
    """Names and at most three rows of a CSV file (SRC17)."""
    path = scratch_folder(spark, "peek")
    Out.write_csv(idioms(spark, d).select("idiom", "meaning"), path)
    few = R.peek(spark, path)
    names = spark.createDataFrame([(c,) for c in few.columns], "name string")
    return names.unionByName(few.agg(F.when(F.count(F.lit(1)) <= 3, "rows <= 3").alias("name")))


@query("q_report_json", "SELECT count(*) AS total_rows, count(DISTINCT p_brand) AS brands, max(p_size) AS largest FROM part")
def _report(spark, d):
    """A one-row report written as JSON and parsed again (SNK4)."""
    path = scratch_folder(spark, "report")
    Out.write_report(table(spark, d, "part").agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct("p_brand").alias("brands"), F.max("p_size").alias("largest")), path)
    return R.read_json_lines(spark, path, "total_rows long, brands long, largest int").select("entry.*")


@query("q_markdown", "SELECT line FROM (SELECT '# Brands' AS line UNION ALL SELECT concat(chr(10), '## ', p_brand, chr(10), chr(10), '| metric | value |', chr(10), '|---|---|') FROM part GROUP BY p_brand UNION ALL SELECT concat('| rows | ', count(*), ' |') FROM part GROUP BY p_brand UNION ALL SELECT concat('| largest | ', max(p_size), ' |') FROM part GROUP BY p_brand)")
def _markdown(spark, d):
    """(SNK7)"""
    found = table(spark, d, "part").groupBy(F.col("p_brand").alias("section")).agg(F.count(F.lit(1)).cast("string").alias("rows"), F.max("p_size").cast("string").alias("largest"))
    long = found.unpivot(["section"], ["rows", "largest"], "metric", "value")
    return Out.markdown(long, "Brands")


@query("q_publish", "SELECT name, kind, count(*) AS n FROM (SELECT p_size % 3 AS name FROM part), (SELECT unnest(['csv', 'parquet']) AS kind) GROUP BY 1, 2")
def _publish(spark, d):
    """Named tables, each as Parquet and CSV (SNK9)."""
    folder, part = scratch_folder(spark, "publish"), table(spark, d, "part").select((F.col("p_size") % 3).alias("name"), "p_name")
    Out.publish({f"t{k}": part.where(F.col("name") == k) for k in range(3)}, folder)
    found = [R.read_any(spark, f"{folder}/t{k}.{kind}").select(F.col("name").cast("int").alias("name"), F.lit(kind).alias("kind")) for k in range(3) for kind in ("csv", "parquet")]
    return reduce(lambda a, b: a.unionByName(b), found).groupBy("name", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("q_checkpoint_stage", "SELECT count(*) AS n, 1 AS run FROM part")
def _stage(spark, d):
    """A stage written once: the second run finds it and keeps it (SNK10)."""
    path = scratch_folder(spark, "stage")
    for run in (1, 2):
        done = Out.checkpoint_stage(table(spark, d, "part").select("p_partkey", F.lit(run).alias("run")), path)
    return done.groupBy("run").agg(F.count(F.lit(1)).alias("n"))


@query("q_request_lines", "SELECT concat('r_', p_partkey) AS custom_id, p_name AS idiom FROM part")
def _requests(spark, d):
    """Request lines written and parsed again (SNK5)."""
    path = scratch_folder(spark, "requests")
    value = F.to_json(F.struct(F.concat(F.lit("r_"), F.col("p_partkey").cast("string")).alias("custom_id"), F.struct(F.col("p_name").alias("input")).alias("body")))
    Out.write_requests(table(spark, d, "part").select(value.alias("value")), path)
    return R.read_json_lines(spark, path, "custom_id string, body struct<input:string>").select("entry.custom_id", F.col("entry.body.input").alias("idiom"))


@query("q_bar_chart", "SELECT p_brand AS label, count(*) AS n, round(count(*) / max(count(*)) OVER (), 4) AS height FROM part GROUP BY 1")
def _bars(spark, d):
    """The data of a bar chart with labels (SNK8)."""
    return St.bars(table(spark, d, "part"), "p_brand")


# --- crawled pages ---------------------------------------------------------------------------------------------------------------------
HTML = "concat('<html><head><title>x</title></head><body><script>var a = 1;</script><p>', p_name, '</p><div class=\"entry word\"> ', p_name, ' </div><div class=\"meaning\">a &amp; <b>', p_type, '</b></div><div class=\"example\">so ', p_brand, '</div><p>by someone</p><a href=\"/define.php?term=', replace(p_name, ' ', '%20'), '\">own</a><a href=\"/define.php?term=two+', p_size, '\">b</a><a href=\"/define.php?x=1&amp;term=two+', p_size, '\">again</a></body></html>')"


def made_pages(spark, d):
    return R.dealt(table(spark, d, "part")).selectExpr("p_partkey AS page_id", "p_name AS term", f"{HTML} AS html")


@query("q_page_classes", "SELECT p_partkey AS page_id, 0 AS at, p_name AS term, concat('a & ', p_type) AS meaning, concat('so ', p_brand) AS example FROM part")
def _classes(spark, d):
    return Pages.class_entries(made_pages(spark, d))


@query("q_page_lines", f"SELECT p_partkey AS page_id, 0 AS \"at\", {s_key('p_name')} AS term, p_name AS meaning, 'a &' AS example FROM part WHERE {s_count('p_name')} BETWEEN 2 AND 8")
def _page_lines(spark, d):
    """The lines after the term's, up to an author's line: here the term's heading again is the first of them (SRC13)."""
    return Pages.text_entries(made_pages(spark, d))


@query("q_term_links", "SELECT p_partkey AS page_id, k AS \"at\", CASE k WHEN 0 THEN p_name ELSE concat('two ', p_size) END AS term FROM part, (SELECT unnest([0, 1]) AS k)")
def _term_links(spark, d):
    """Terms of links, decoded and distinct, in order (SRC14)."""
    return Pages.links(made_pages(spark, d))


@query("q_crawl", """WITH RECURSIVE p AS (SELECT page_id, list_transform(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']([^"'']+)["'']', 1), lambda u: lower(ltrim(u, '/'))) AS urls FROM pages),
f AS (SELECT term, urls FROM (SELECT urls[1] AS term, urls, row_number() OVER (PARTITION BY urls[1] ORDER BY page_id) AS k FROM p WHERE len(urls) > 0) WHERE k = 1),
l AS MATERIALIZED (SELECT term, other, min(pos) AS pos FROM (SELECT term, unnest(urls) AS other, unnest(range(len(urls))) AS pos FROM f) WHERE other IN (SELECT term FROM f) GROUP BY term, other),
walk AS (SELECT term, 0 AS depth, [rank() OVER (ORDER BY term)] AS path FROM f WHERE term IN ('the', 'der', 'les', 'los', 'thanks') UNION ALL SELECT l.other, depth + 1, list_append(path, pos) FROM walk JOIN l ON walk.term = l.term WHERE depth < 4),
best AS (SELECT term, min(struct_pack(depth := depth, path := path)) AS place FROM walk GROUP BY term)
SELECT row_number() OVER (ORDER BY place) - 1 AS "at", term, place.depth AS depth FROM best ORDER BY place LIMIT 60""")
def _crawl(spark, d):
    """Breadth first over stored pages, each under its first link: four steps from a few seeds, each term once, targets without a page skipped (JN11)."""
    links = Pages.all_links(table(spark, d, "pages")).select("page_id", "at", F.lower(F.ltrim("url", F.lit("/"))).alias("other"))
    first = D.best_row(links.where("at = 0"), ["other"], ["page_id"]).select("page_id", F.col("other").alias("term"))
    targets = links.join(first, "page_id").select("term", "at", "other")
    seeds = first.where(F.col("term").isin("the", "der", "les", "los", "thanks")).select("term")
    return J.crawl_stored(first.select("term"), targets, W.running_number(seeds, ["term"], "at", 0), 60, 4)


@query("q_crawl_statistics", "SELECT count(*) AS pages, count(*) FILTER (p_partkey % 5 <> 0) AS fetched, count(*) FILTER (p_partkey % 5 = 0) AS failed, count(*) FILTER (p_partkey % 5 <> 0) AS pages_with_entries, count(*) FILTER (p_partkey % 5 <> 0) AS entries, count(*) FILTER (p_partkey % 5 <> 0) AS with_meaning, count(DISTINCT CASE WHEN p_partkey % 5 <> 0 THEN lower(p_name) END) AS unique_terms FROM part")
def _crawl_statistics(spark, d):
    """(AG31)"""
    pages = made_pages(spark, d).withColumn("html", F.when(F.col("page_id") % 5 != 0, F.col("html")))
    return St.crawl_statistics(pages, Pages.class_entries(pages))


# --- schema ----------------------------------------------------------------------------------------------------------------------------
@query("q_source_schema", "SELECT idiom, meaning AS meaning_en, example, 'kaikki_wiktionary' AS source, 'dictionary' AS source_type, pos, tags, 'high' AS idiom_confidence, '' AS source_url FROM idioms", idioms=IDIOMS_SQL)
def _source_schema(spark, d):
    return Sch.to_source_schema(idioms(spark, d), "kaikki_wiktionary", "dictionary", "high")


@query("q_normalized_columns", f"SELECT _pos, {s_norm('idiom')} AS idiom, {s_norm('tags')} AS tags, example FROM idioms", idioms=IDIOMS_SQL)
def _normalized(spark, d):
    return Sch.normalize_columns(idioms(spark, d), ["idiom", "tags", "absent"]).select("_pos", "idiom", "tags", "example")


@query("q_resolved_column", "SELECT 'idiom' AS name, count(idiom) AS n FROM idioms UNION ALL SELECT 'none', 0", idioms=IDIOMS_SQL)
def _resolved(spark, d):
    rows = idioms(spark, d)
    name = Sch.resolve(rows, "idiom_canonical", "idiom", "term")
    assert Sch.resolve(rows, "absent") is None
    return rows.agg(F.lit(name).alias("name"), F.count(name).alias("n")).unionByName(spark.sql("SELECT 'none' AS name, 0L AS n"))


@query("q_comparison_view", f"SELECT _pos, {s_key('idiom')} AS i, {s_key('meaning')} AS m, _pos AS r FROM idioms", idioms=IDIOMS_SQL)
def _comparison(spark, d):
    return Sch.comparison_view(idioms(spark, d), "idiom", "meaning", "example").select("_pos", F.col("_idiom_cmp").alias("i"), F.col("_meaning_cmp").alias("m"), F.col("_row_id_cmp").alias("r"))


@query("q_align_target", "SELECT idiom AS idiom_canonical, coalesce(pos, 'phrase') AS pos, 'modern' AS origin, NULL::VARCHAR AS note FROM idioms", idioms=IDIOMS_SQL)
def _align_target(spark, d):
    """Rename, constants as defaults, nulls, and the target's order (PRJ10, PRJ18, PRJ20)."""
    return Sch.align_to(idioms(spark, d), ["idiom_canonical", "pos", "origin", "note"], {"idiom": "idiom_canonical"}, {"pos": "phrase", "origin": "modern"})


@query("q_promoted_example", "SELECT _pos, example AS example_raw, meaning AS example FROM idioms", idioms=IDIOMS_SQL)
def _promoted(spark, d):
    return Sch.promote_example(idioms(spark, d).withColumnRenamed("meaning", "idiom_in_example")).select("_pos", "example_raw", "example")


@query("q_reserved_example", f"SELECT _pos, '' AS example, coalesce(nullif({s_safe('tags')}, ''), example) AS example_raw FROM idioms", idioms=IDIOMS_SQL)
def _reserved(spark, d):
    return Sch.reserve_example(idioms(spark, d).withColumnRenamed("tags", "example_raw")).select("_pos", "example", "example_raw")


@query("q_coerced_types", "SELECT _pos, CASE _pos % 3 WHEN 0 THEN 1.5 WHEN 1 THEN NULL ELSE 2.0 END::DOUBLE AS score, CASE _pos % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS flag, nullif(nullif(tags, ''), 'nan') AS tags FROM idioms", idioms=IDIOMS_SQL)
def _coerced(spark, d):
    rows = idioms(spark, d).select("_pos", "tags", F.expr("case _pos % 3 when 0 then '1.5' when 1 then 'n/a' else '2' end").alias("score"), F.expr("case _pos % 4 when 0 then 'True' when 1 then '0' when 2 then 'yes' else 'maybe' end").alias("flag"))
    return Sch.coerce_types(rows, numeric=["score"], boolean=["flag"], text=["tags"])


@query("q_schema_diff", "SELECT side, c AS \"column\", n FROM (SELECT unnest(['shared', 'shared', 'left_only', 'right_only']) AS side, unnest(['_pos', 'idiom', 'tags', 'pos']) AS c, unnest([count(*) FILTER (_pos IS NOT NULL) * 2, count(*) FILTER (idiom IS NOT NULL) * 2, count(*) FILTER (tags IS NOT NULL), count(*) FILTER (pos IS NOT NULL)]) AS n FROM idioms)", idioms=IDIOMS_SQL)
def _schema_diff(spark, d):
    """Shared and one-sided columns of two tables, with the values that they hold (PRJ15, ST4)."""
    rows = idioms(spark, d)
    return Sch.schema_contents(rows.select("_pos", "idiom", "tags"), rows.select("_pos", "idiom", "pos"))


@query("q_adversarial_mark", "SELECT _pos, contains(row_type, 'adversarial') AS is_adversarial FROM enriched", enriched=ENRICHED_SQL)
def _mark(spark, d):
    return Sch.mark_adversarial(enriched(spark, d)).select("_pos", "is_adversarial")


@query("q_valid_only", "SELECT _pos, coalesce(tags, '') AS tags, idiom FROM idioms WHERE _pos % 2 = 0 AND _pos % 3 = 0", idioms=IDIOMS_SQL)
def _valid_only(spark, d):
    """Valid rows of the generated branch, null texts as '' (UD22)."""
    rows = idioms(spark, d).select("_pos", "idiom", "tags", F.expr("_pos % 2 = 0").alias("is_idiom"), F.expr("case when _pos % 3 = 0 then 'valid_idiom' when _pos % 3 = 1 then 'invalid' end").alias("idiom_validity_label"))
    return Pub.valid_only(rows).select("_pos", "idiom", "tags")


@query("q_has_canonical", f"SELECT _pos FROM idioms WHERE {s_safe('meaning')} <> ''", idioms=IDIOMS_SQL)
def _has_canonical(spark, d):
    """Rows without a canonical idiom go (FLT38)."""
    return idioms(spark, d).withColumnRenamed("meaning", "idiom_canonical").where(P.has_canonical()).select("_pos")


# --- joins, windows, lists -------------------------------------------------------------------------------------------------------------
@query("q_add_metadata", "SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _add_metadata(spark, d):
    source = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return J.add_metadata(table(spark, d, "orders").select("o_orderkey", "o_custkey"), source, "o_custkey").drop("o_custkey")


RESOLVED = "SELECT custom_id, coalesce(a.p_name, b.p_name) AS idiom FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN concat('id_', user_id) WHEN 1 THEN concat('row_', user_id) ELSE 'none' END AS custom_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS i, CASE WHEN event_id % 3 = 1 THEN user_id END AS k FROM events) LEFT JOIN part a ON a.p_partkey = i LEFT JOIN part b ON b.p_partkey = k WHERE coalesce(a.p_name, b.p_name) IS NOT NULL"


@query("q_resolved_ids", RESOLVED)
def _resolved_ids(spark, d):
    """Results found by id, else by the trailing number as position; others go (JN3)."""
    results = table(spark, d, "events").selectExpr("case event_id % 3 when 0 then concat('id_', user_id) when 1 then concat('row_', user_id) else 'none' end AS custom_id")
    raw = table(spark, d, "part").selectExpr("concat('id_', p_partkey) AS idiom_id", "p_partkey AS _pos", "p_name")
    return J.resolve_ids(results, raw).select("custom_id", F.col("raw.p_name").alias("idiom"))


@query("q_scanned_rows", "SELECT _pos FROM idioms WHERE _pos < 40", idioms=IDIOMS_SQL)
def _scanned(spark, d):
    return W.scanned(idioms(spark, d), 40).select("_pos")


@query("q_first_rows", "SELECT _pos FROM idioms ORDER BY size DESC, _pos LIMIT 25", idioms=IDIOMS_SQL)
def _first_rows(spark, d):
    return W.head(idioms(spark, d), [F.desc("size"), "_pos"], 25).select("_pos")


@query("q_tier_split", "SELECT doc_id FROM documents WHERE lang = 'fr' AND (('0x' || substr(md5(source), 1, 4))::INT % 100) >= 80")
def _tier_split(spark, d):
    """One cell of tier and split (SL11)."""
    rows = W.split_by_key(table(spark, d, "documents").withColumnRenamed("lang", "tier"), "source")
    return W.tier_split(rows, "fr", "test").select("doc_id")


@query("q_split_leaks", "SELECT count(*) AS overlap FROM (SELECT source FROM (SELECT source, CASE WHEN (('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::INT % 100) < 80 THEN 1 ELSE 0 END AS s FROM documents) GROUP BY source HAVING count(DISTINCT s) > 1)")
def _split_leaks(spark, d):
    """A split by another key does leak: the check must count it (SL10)."""
    return W.split_overlap(W.split_by_key(table(spark, d, "documents"), "doc_id"), "source")


@query("q_merged_tags", "SELECT p_partkey, concat(lower(p_type), ',odd,', lower(p_brand)) AS tags FROM part")
def _merged_tags(spark, d):
    """Ordered and distinct (SC14)."""
    return table(spark, d, "part").select("p_partkey", T.merge_tags(F.array(F.lower("p_type"), F.lit("odd"), F.lit("")), F.array(F.lit("odd"), F.lower("p_brand"))).alias("tags"))


@query("q_encoded_texts", "SELECT p_partkey, length(p_name)::DOUBLE AS chars, len(string_split(p_name, ' '))::DOUBLE AS words FROM part")
def _encoded(spark, d):
    """Vectors by an injected encoder in batches (UD14)."""
    encoder = lambda texts: [[len(t), len(t.split(" "))] for t in texts]
    rows = E.encode_texts(table(spark, d, "part").select("p_partkey", "p_name"), encoder, "p_name")
    return rows.select("p_partkey", F.col("embedding")[0].cast("double").alias("chars"), F.col("embedding")[1].cast("double").alias("words"))


# --- best rows by each operator's own key and score ---------------------------------------------------------------------------------------
def s_first(keys: str, order: str = "_pos", rows: str = "idioms") -> str:
    return f"SELECT _pos FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS r FROM {rows}) WHERE r = 1"


@query("q_dedup_case_sensitive", s_first("idiom, meaning"), idioms=IDIOMS_SQL)
def _dedup_exact(spark, d):
    """(DD25)"""
    return D.first_row(idioms(spark, d), ["idiom", "meaning"]).select("_pos")


@query("q_dedup_idiom_example", s_first(f"lower({s_norm('idiom')}), lower({s_norm('example')})"), idioms=IDIOMS_SQL)
def _dedup_example(spark, d):
    """(DD17, DD23)"""
    return D.first_row(idioms(spark, d), [T.lower_norm("idiom"), T.lower_norm("example")]).select("_pos")


@query("q_dedup_key_list", s_first("brand, size, source"), idioms=IDIOMS_SQL)
def _dedup_keys(spark, d):
    """(DD16)"""
    return D.first_row(idioms(spark, d), ["brand", "size", "source"]).select("_pos")


@query("q_dedup_crawled", f"SELECT _pos FROM ({s_first(s_key('idiom'))}) JOIN (SELECT _pos AS p, meaning FROM idioms) ON _pos = p WHERE {s_norm('meaning')} <> ''", idioms=IDIOMS_SQL)
def _dedup_crawled(spark, d):
    """First per term, then rows without a meaning go, even if a later row of the term had one (DD22)."""
    rows = D.first_row(idioms(spark, d), [T.idiom_key("idiom")])
    return rows.where(T.norm("meaning") != "").select("_pos")


@query("q_dedup_triples_then_best", f"SELECT _pos FROM (SELECT *, row_number() OVER (PARTITION BY {s_key('idiom')} ORDER BY length(meaning) DESC, _pos) AS b FROM (SELECT *, row_number() OVER (PARTITION BY {s_key('idiom')}, {s_key('meaning')}, {s_norm('example')} ORDER BY _pos) AS r FROM idioms) WHERE r = 1) WHERE b = 1", idioms=IDIOMS_SQL)
def _dedup_triples(spark, d):
    """Exact triples first, then the best row of each idiom (DD10)."""
    rows = D.first_row(idioms(spark, d), [T.idiom_key("idiom"), T.idiom_key("meaning"), T.norm("example")])
    return D.best_scored(rows, [T.idiom_key("idiom")], F.length("meaning")).select("_pos")


@query("q_best_then_meaning_order", s_first(s_key("idiom"), "size DESC, meaning, _pos"), idioms=IDIOMS_SQL)
def _best_meaning(spark, d):
    """Highest score, ties by meaning, then by position (DD8, DD9)."""
    return D.best_scored(idioms(spark, d), [T.idiom_key("idiom")], F.col("size"), "meaning").select("_pos")


@query("q_branch_priority", "SELECT _pos, source FROM (SELECT *, row_number() OVER (PARTITION BY brand, size ORDER BY CASE source WHEN 'urban_dictionary' THEN 1 WHEN 'wordnet' THEN 2 ELSE 3 END, _pos) AS r FROM idioms) WHERE r = 1", idioms=IDIOMS_SQL)
def _priority(spark, d):
    """The listed sources first, in their order (DD15)."""
    return D.by_priority(idioms(spark, d), ["brand", "size"], "source", ["urban_dictionary", "wordnet"]).select("_pos", "source")


@query("q_rank_by_example", "SELECT _pos, row_number() OVER (PARTITION BY idiom_id ORDER BY idiom_in_example, _pos) AS rank FROM enriched WHERE contains(row_type, 'adversarial')", enriched=ENRICHED_SQL)
def _rank_by_example(spark, d):
    """(WN2)"""
    rows = enriched(spark, d).where(F.contains("row_type", F.lit("adversarial")))
    return W.numbered(rows, ["idiom_id"], ["idiom_in_example", "_pos"]).select("_pos", "rank")


@query("q_exclusion_samples", "SELECT i, p_partkey FROM (SELECT i, p_partkey, row_number() OVER (PARTITION BY i ORDER BY md5(concat(p_partkey, 42 + i)), p_partkey) AS r FROM part, (SELECT unnest([0, 1, 2]) AS i)) WHERE r <= 20")
def _exclusions(spark, d):
    """A seeded sample for each category, by seeds 42 + i (SL8)."""
    part = table(spark, d, "part").select("p_partkey")
    return reduce(lambda a, b: a.unionByName(b), [W.sample(part, "p_partkey", 20, 42 + i).select(F.lit(i).alias("i"), "p_partkey") for i in range(3)])


@query("q_shared_rows", "SELECT lang, n_chars % 50 AS size FROM documents WHERE doc_id % 2 = 0 INTERSECT SELECT lang, n_chars % 50 FROM documents WHERE doc_id % 2 = 1")
def _shared(spark, d):
    """Distinct rows of two tables (ST3)."""
    docs = table(spark, d, "documents").withColumn("size", F.col("n_chars") % 50)
    return W.overlap(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"), ["lang", "size"])


@query("q_merge_order", "SELECT _pos, row_number() OVER (ORDER BY idiom_id, CASE row_type WHEN 'main_example' THEN 1 WHEN 'adversarial_example_1' THEN 2 WHEN 'adversarial_example_2' THEN 3 ELSE 99 END, context_type, example_usage_label, idiom_in_example, _pos) AS place FROM enriched", enriched=ENRICHED_SQL)
def _merge_order(spark, d):
    """The order of the merge, numbered, so that the sort itself is compared (SL2)."""
    return W.running_number(enriched(spark, d), Pub.merge_columns(), "place").select("_pos", "place")


CORE = ("total_rows", "unique_idioms", "unique_meanings", "rows_with_meaning", "rows_with_example", "avg_idiom_tokens", "min_idiom_tokens", "max_idiom_tokens", "avg_meaning_tokens", "avg_example_tokens")


@query("q_full_report", "SELECT 'core' AS section, m AS metric, v AS value FROM (SELECT unnest([" + ", ".join(f"'{m}'" for m in CORE) + "]) AS m, unnest([" + ", ".join(f"{m}::VARCHAR" for m in CORE) + "]) AS v FROM core) UNION ALL SELECT 'pos', coalesce(pos, 'MISSING'), count(*)::VARCHAR FROM idioms GROUP BY 2 UNION ALL SELECT 'source', source, count(*)::VARCHAR FROM idioms GROUP BY 2 UNION ALL SELECT 'missing', c, n::VARCHAR FROM (SELECT unnest(['example', 'tags', 'pos']) AS c, unnest([count(*) FILTER (example IS NULL), count(*) FILTER (tags IS NULL), count(*) FILTER (pos IS NULL)]) AS n FROM idioms) WHERE n > 0", idioms=IDIOMS_SQL, core=CORE_SQL)
def _full_report(spark, d):
    """Core counts, distributions and missing values in one long table (AG4, AG11, AG30, AG34)."""
    return St.full_report(idioms(spark, d), ("idiom", "meaning", "example"), ["pos", "source"], {})


@query("q_filter_previews", "SELECT kind, _pos FROM (SELECT 'broad' AS kind, _pos, row_number() OVER (ORDER BY idiom, _pos) AS r FROM idioms WHERE size < 30 UNION ALL SELECT 'high', _pos, row_number() OVER (ORDER BY idiom, _pos) FROM idioms WHERE size < 10) WHERE r <= 20", idioms=IDIOMS_SQL)
def _previews(spark, d):
    """The first 20 rows of the broad and the high set (AG33, SL5)."""
    sets = {"broad": idioms(spark, d).where("size < 30"), "high": idioms(spark, d).where("size < 10")}
    return reduce(lambda a, b: a.unionByName(b), [W.head(rows, ["idiom", "_pos"], 20).select(F.lit(kind).alias("kind"), "_pos") for kind, rows in sets.items()])


# --- slang senses, publication -----------------------------------------------------------------------------------------------------------
SLANG_WORDS = "SELECT p_partkey AS _pos, p_name, p_type, p_brand, CASE p_partkey % 5 WHEN 0 THEN 'verb' WHEN 1 THEN 'name' WHEN 2 THEN 'phrase' ELSE 'noun' END AS pos FROM part"
_SLANG_OK = f"{s_count('p_name')} BETWEEN 2 AND 8 AND pos <> 'name'"


@query("q_slang_senses", f"SELECT _pos, i AS sense_index, {s_key('p_name')} AS idiom, CASE i WHEN 0 THEN concat('to act like ', lower(p_type)) ELSE 'a fool, slang for one' END AS meaning_en, CASE i WHEN 0 THEN concat('ex ', p_name) ELSE '' END AS example, pos FROM words, (SELECT unnest([0, 2]) AS i) WHERE {_SLANG_OK}", words=SLANG_WORDS)
def _slang(spark, d):
    """Shape, part of speech, exact bad tags, meaning and signal of dictionary slang, whatever the language (UD2, FLT15)."""
    none = F.array().cast("array<string>")
    sense = lambda **k: F.struct(*[k.get(c, none).alias(c) for c in ("tags", "topics", "glosses", "raw_glosses")], k.get("examples", none).alias("examples"))
    senses = F.array(
        sense(tags=F.array(F.lit("slang")), glosses=F.array(F.concat(F.lit("to act like "), F.lower("p_type"))), examples=F.array(F.concat(F.lit("ex "), "p_name"))),
        sense(tags=F.array(F.lit("slang"), F.lit("alt-of")), glosses=F.array(F.lit("of a bad tag"))),
        sense(glosses=F.array(F.lit("a fool, slang for one"))),
        sense(glosses=F.array(F.lit("without any signal at all"))),
    )
    kind = F.expr("case p_partkey % 5 when 0 then 'verb' when 1 then 'name' when 2 then 'phrase' else 'noun' end")
    entry = F.struct(F.col("p_name").alias("word"), F.lit("French").alias("lang"), kind.alias("pos"), F.lit("u").alias("wiktionary_url"), senses.alias("senses"))
    parsed = R.parse_json_lines(table(spark, d, "part").select(F.col("p_partkey").alias("_pos"), F.to_json(entry).alias("value")))
    return R.slang_senses(parsed).select("_pos", "sense_index", "idiom", "meaning_en", "example", "pos")


PUBLISHED = {
    "_pos": "doc_id", "idiom_canonical": "case when doc_id % 11 = 0 then lower(source) else source end", "example": "case when doc_id % 13 = 0 then source when doc_id % 17 = 0 then 'tiny text' when doc_id % 19 = 0 then '...' when doc_id % 23 = 0 then concat('en : ', text) else text end",
    "example_usage_label": "case doc_id % 3 when 0 then 'idiomatic' when 1 then 'literal' end", "is_example_idiom": "case when doc_id % 7 = 0 then true when doc_id % 7 = 1 then false end", "record_origin": "case doc_id % 4 when 0 then 'modern_pipeline' when 1 then 'llm_enriched_v2' when 2 then 'synthetic_llm_enriched' else 'other' end",
    "idiom_confidence": "case when doc_id % 5 = 0 then 'low' end", "idiom_validity_label": "case when doc_id % 6 = 0 then 'own' end", "validation_status": "case doc_id % 4 when 0 then 'corrected' when 1 then 'verified' when 2 then 'needs_review' end", "slang_strength": "case when doc_id % 8 = 0 then 'x' end",
    "idiom_register": "case doc_id % 4 when 0 then 'Slang' when 1 then 'informal' when 2 then 'formal' end", "idiom_domain": "lang", "row_type": "'main_example'", "tags": "case when doc_id % 2 = 0 then 'own' else ' ' end", "context_type": "lang",
}
PUBLISHED_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in PUBLISHED.items()) + " FROM documents"


def published(spark, d):
    return table(spark, d, "documents").selectExpr(*[f"{e} AS {c}" for c, e in PUBLISHED.items()])


def s_delete(c: str) -> str:
    return s_norm(f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')")


def s_space(c: str) -> str:
    return s_norm(f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')")


CORRUPTED = "(regexp_matches(example, 'idiom_in_example_|(?:meaning[_\\s]?.*?:)|(?:en\\s*:)') OR (len(example) - len(replace(example, ':', '')) >= 2 AND length(example) > 300))"


@query("q_clean_examples", f"SELECT _pos, length(example) AS sentence_length_chars, {s_count('example')} AS sentence_length_words, md5({s_delete('example')}) AS example_normalized FROM rows WHERE NOT {CORRUPTED} AND {s_delete('example')} <> '' AND ({s_space('example')} <> {s_space('idiom_canonical')} OR example_usage_label = 'idiomatic') AND length(example) > 15", rows=PUBLISHED_SQL)
def _clean_examples(spark, d):
    """(FLT29-FLT32, SC49)"""
    return Pub.clean_examples(published(spark, d)).select("_pos", F.col("sentence_length_chars"), F.col("sentence_length_words"), F.md5(F.col("example_normalized").cast("binary")).alias("example_normalized"))


FILLED = "SELECT _pos, coalesce(idiom_confidence, CASE record_origin WHEN 'modern_pipeline' THEN 'high' WHEN 'llm_enriched_v2' THEN 'medium' WHEN 'synthetic_llm_enriched' THEN 'synthetic' END) AS idiom_confidence, coalesce(idiom_validity_label, CASE WHEN example_usage_label IS NOT NULL AND idiom_canonical IS NOT NULL AND example IS NOT NULL THEN CASE validation_status WHEN 'corrected' THEN 'corrected_valid' WHEN 'verified' THEN 'valid' END END) AS idiom_validity_label, coalesce(slang_strength, CASE idiom_register WHEN 'Slang' THEN 'high' WHEN 'informal' THEN 'medium' WHEN 'formal' THEN 'none' END) AS slang_strength, CASE WHEN trim(tags) = '' THEN array_to_string(list_filter([coalesce(idiom_register, ''), coalesce(idiom_domain, ''), row_type, coalesce(example_usage_label, '')], lambda t: t <> ''), ', ') ELSE tags END AS tags FROM rows"


@query("q_fill_metadata", FILLED, rows=PUBLISHED_SQL)
def _fill_metadata(spark, d):
    """(SC15, SC47)"""
    return Pub.fill_metadata(published(spark, d)).select("_pos", "idiom_confidence", "idiom_validity_label", "slang_strength", "tags")


@query("q_fill_defaults", "SELECT _pos, coalesce(idiom_confidence, '1.0') AS idiom_confidence, record_origin, 'modern_combined' AS source, 'phrase' AS pos, 'modern_v1' AS enrichment_version FROM rows", rows=PUBLISHED_SQL)
def _fill_defaults(spark, d):
    """(SC48)"""
    return Pub.fill_defaults(published(spark, d)).select("_pos", "idiom_confidence", "record_origin", "source", "pos", "enrichment_version")


@query("q_fill_pairs", "SELECT _pos, concat('mp_', replace(lower(coalesce(idiom_canonical, '')), ' ', '_'), '__', replace(lower(coalesce(context_type, '')), ' ', '_'), '__', lower(example_usage_label), '__', row_number() OVER (PARTITION BY idiom_canonical, context_type, example_usage_label ORDER BY _pos) - 1) AS minimal_pair_id FROM rows WHERE example_usage_label IS NOT NULL", rows=PUBLISHED_SQL)
def _fill_pairs(spark, d):
    """(WN5, SC56)"""
    rows = published(spark, d).where("example_usage_label is not null").withColumn("minimal_pair_id", F.lit(None).cast("string"))
    return Pub.fill_pair_ids(rows).select("_pos", "minimal_pair_id")


PUBLICATION = f"""SELECT _pos, coalesce(example_usage_label, CASE is_example_idiom WHEN true THEN 'idiomatic' WHEN false THEN 'literal' END, 'idiomatic') AS label, CASE WHEN (('0x' || substr(md5(norm), 1, 4))::INT % 100) < 80 THEN 'train' ELSE 'test' END AS split FROM (SELECT *, {s_delete('example')} AS norm, {s_space('example')} AS sp FROM rows WHERE NOT {CORRUPTED} AND length(example) > 15) WHERE norm <> '' AND sp <> {s_space('idiom_canonical')} AND sp NOT IN (SELECT sp FROM (SELECT {s_space('example')} AS sp, idiom_canonical FROM rows WHERE NOT {CORRUPTED} AND length(example) > 15 AND {s_delete('example')} <> '' AND {s_space('example')} <> {s_space('idiom_canonical')}) GROUP BY 1 HAVING count(DISTINCT idiom_canonical) > 1)"""


@query("q_publication", PUBLICATION, rows=PUBLISHED_SQL)
def _publication(spark, d):
    """The publication chain: clean examples, labels, metadata, quality and a split without leakage (FLT29-FLT34, SC46-SC54, SL9)."""
    rows = published(spark, d).withColumns({"idiom_canonical_meaning": F.col("idiom_domain"), "idiom_in_example_meaning_en": F.col("row_type")})
    return Plan.publication(rows).select("_pos", F.col("example_usage_label").alias("label"), "split")


@query("q_flatten_generated", "SELECT concat('id_', p_partkey) AS idiom_id, 'main_example' AS row_type, p_name AS idiom_in_example FROM part UNION ALL SELECT concat('id_', p_partkey), 'adversarial_example', p_brand FROM part")
def _flatten_generated(spark, d):
    """The generated branch's records have their example texts in ``example`` (UD5)."""
    record = F.struct(F.lit(True).alias("is_idiom"), F.array(F.struct(F.col("p_name").alias("example"))).alias("examples"), F.array(F.struct(F.col("p_brand").alias("example"))).alias("adversarial_examples"))
    body = F.struct(F.lit("m").alias("model"), F.array(F.struct(F.lit("message").alias("type"), F.array(F.struct(F.lit("output_text").alias("type"), F.to_json(record).alias("text"))).alias("content"))).alias("output"))
    results = table(spark, d, "part").select(F.to_json(F.struct(F.concat(F.lit("id_"), F.col("p_partkey").cast("string")).alias("custom_id"), F.struct(body.alias("body")).alias("response"))).alias("value"))
    return E.flatten_extended(E.parse_results(results), "example").select("idiom_id", "row_type", "idiom_in_example")


# --- services --------------------------------------------------------------------------------------------------------------------------
@query("q_branch_requests", "SELECT branch, CASE WHEN _pos % 4 = 0 THEN concat(branch, CASE branch WHEN 'core' THEN '_v2_' ELSE '_v1_' END, _pos) ELSE concat('i', _pos) END AS custom_id, idiom AS idiom, true AS has_example FROM idioms, (SELECT unnest(['core', 'modern', 'generated']) AS branch)", idioms=IDIOMS_SQL)
def _branch_requests(spark, d):
    """Requests of the three branches: ids, fallback ids, and each branch's own example column (UD21)."""
    rows = idioms(spark, d).select("_pos", F.col("idiom").alias("idiom_canonical"), F.col("meaning").alias("idiom_canonical_meaning"), F.col("tags").alias("example"), F.col("example").alias("example_raw"), F.when(F.col("_pos") % 4 != 0, F.concat(F.lit("i"), F.col("_pos").cast("string"))).alias("idiom_id"))
    schema = E.json_schema({"is_idiom": "boolean", "examples": ({"text": "string"}, 12)})
    found = []
    for branch, (_, example, _) in E.BRANCHES.items():
        tail = F.concat(F.lit("Known example: "), F.coalesce(F.col(example), F.lit("")))
        lines_ = E.branch_requests(rows.withColumn("idiom_canonical", F.concat_ws("\u241f", "idiom_canonical", tail)), branch, "m", schema)
        entry = F.parse_json("value")
        prompt = F.try_variant_get(entry, "$.body.input", "string")
        own = F.split(F.regexp_extract(prompt, "(?s)(?:idiom|expression) (.*?)(?: and write|, reject| is an idiom)", 1), "\u241f")
        found.append(lines_.select(F.lit(branch).alias("branch"), F.try_variant_get(entry, "$.custom_id", "string").alias("custom_id"), own[0].alias("idiom"), F.endswith(prompt, own[1]).alias("has_example")))
    return reduce(lambda a, b: a.unionByName(b), found)


@query("q_generation_requests", "SELECT concat('missing_idioms_', lower(p_type), '_v1') AS custom_id, concat('Propose idioms about ', lower(p_type), ' but none of: ', string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand)) AS prompt FROM part GROUP BY lower(p_type)")
def _generation_requests(spark, d):
    """One request for each category with the idioms not to propose (UD21)."""
    lists = table(spark, d, "part").groupBy(F.lower("p_type").alias("category")).agg(F.array_sort(F.collect_set("p_brand")).alias("excluded"))
    made = E.generation_requests(lists, "Propose idioms about {category} but none of: {excluded}", "m")
    v = F.parse_json("value")
    return made.select(F.try_variant_get(v, "$.custom_id", "string").alias("custom_id"), F.try_variant_get(v, "$.body.input", "string").alias("prompt"))


@query("q_json_repair", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 THEN NULL ELSE p_size END AS a, CASE WHEN p_partkey % 5 IN (3, 4) THEN NULL ELSE p_name END AS b FROM part")
def _json_repair(spark, d):
    """Whole JSON, JSON within text, trailing commas, open strings and brackets, and what can't be repaired (SC40, UD15)."""
    text = F.expr("""case p_partkey % 5 when 0 then concat('{"a": ', p_size, ', "b": "', p_name, '"}') when 1 then concat('Sure: {"a": ', p_size, ', "b": "', p_name, '"} done') when 2 then concat('```json {"a": ', p_size, ', "b": "', p_name, '", "c": [1, 2, {"d": "[ open') when 3 then concat('so {"a": ', p_size, ', }') else concat('no json, ', p_name) end""")
    fixed = F.from_json(T.json_repaired(text), "a int, b string")
    return table(spark, d, "part").select("p_partkey", fixed["a"].alias("a"), fixed["b"].alias("b"))


@query("q_lexical_database", "SELECT lower(p_name) AS idiom, concat(p_type, '; of ', p_brand) AS meaning_en, CASE p_size % 2 WHEN 0 THEN 'n' ELSE 'v' END AS pos FROM part WHERE contains(p_name, ' ')")
def _lexical_database(spark, d):
    """Multiword lemmas out of a lexical database's data files (SRC10)."""
    path = scratch_folder(spark, "lexical")
    line = F.expr("""concat(lpad(p_partkey, 8, '0'), ' 04 ', case p_size % 2 when 0 then 'n' else 'v' end, ' 02 ', replace(p_name, ' ', '_'), '(p) 0 single 1 001 @ 00000001 n 0000 | ', p_type, '; of ', p_brand, '; "an example"')""")
    table(spark, d, "part").select(F.explode(F.array(line, F.lit("  1 a line of the licence"))).alias("value")).write.text(path)
    return R.lexical_entries(R.read_lexical_database(spark, path))


@query("q_checkpoint_slices", "SELECT p_partkey, upper(p_name) AS done, 1 AS times FROM part")
def _slices(spark, d):
    """A run that dies after its second batch was saved, and another one that goes on: every row once (SNK10)."""
    folder = scratch_folder(spark, "resumed")
    schema, result = "p_partkey long, p_name string", "p_partkey long, done string"
    part = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name")
    Resume.stage_rows(part, f"{folder}/items", max(1, part.count() // 5))
    step = lambda df: df.select("p_partkey", F.upper("p_name").alias("done"))

    def die(number: int) -> None:
        if number == 1:
            raise InterruptedError("killed before the batch is marked as finished")

    run = lambda after: Resume.work_off(spark, f"{folder}/items", schema, step, f"{folder}/done", f"{folder}/marks", 1, after)
    try:
        run(die)
    except StreamingQueryException:
        run(None)
    return Resume.worked_off(spark, f"{folder}/done", result).groupBy("p_partkey", "done").agg(F.count(F.lit(1)).cast("int").alias("times"))


@query("q_batch_service", "SELECT batch, count(*) AS requests, min(p_partkey) AS first, count(*) FILTER ((batch % 3 <> 0)) AS downloaded, count(*) FILTER (batch % 3 = 0) AS outstanding FROM (SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // 300 AS batch FROM part) GROUP BY batch")
def _service(spark, d):
    """Requests in batches of bounded size, results of the completed ones, and what a next submission still holds (UD16-UD20)."""
    batches = services.batched(table(spark, d, "part").select("p_partkey"), ["p_partkey"], 300)
    results = services.completed(batches, batches.select("batch", F.when(F.col("batch") % 3 == 0, "in_progress").otherwise("completed").alias("status")).distinct())
    left = E.unprocessed(batches, results, "p_partkey")
    both = batches.withColumn("kind", F.lit("request")).unionByName(results.withColumn("kind", F.lit("result"))).unionByName(left.withColumn("kind", F.lit("left")))
    counted = lambda kind: F.count_if(F.col("kind") == kind)
    return both.groupBy("batch").agg(counted("request").alias("requests"), F.min("p_partkey").alias("first"), counted("result").alias("downloaded"), counted("left").alias("outstanding"))
