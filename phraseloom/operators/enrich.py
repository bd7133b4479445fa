"""Enrichment by an external model, data side: requests out, results in, nested records flattened, verdicts merged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phraseloom.functions import text as T

RESULT = "custom_id string, response struct<body: struct<model:string, output: array<struct<type:string, content: array<struct<type:string, text:string>>>>>>"
LEVEL = ("idiom_canonical", "idiom_canonical_meaning", "idiom_canonical_meaning_arabic", "is_idiom boolean", "idiom_validity_label", "ambiguity_flag", "idiom_compositionality_level", "idiom_register", "idiom_domain", "learner_difficulty", "slang_strength", "regionality", "offensive_flag", "hard_negative_idioms array<string>", "meaning_paraphrases_en array<string>", "meaning_paraphrases_ar array<string>", "explanation_en", "explanation_ar")
EXAMPLE = ("context_type", "source_style", "idiom_surface", "idiom_in_example", "example", "idiom_in_example_arabic", "idiom_in_example_meaning_en", "idiom_in_example_meaning_arabic", "is_example_idiom boolean", "example_usage_label", "explanation_en", "explanation_ar")
ADVERSARIAL = ("source_style", "idiom_in_example", "example", "idiom_in_example_arabic", "idiom_in_example_meaning_en", "idiom_in_example_meaning_arabic", "explanation_en", "explanation_ar", "expected_label", "adversarial_type")


def _fields(names: Sequence[str], separator: str) -> str:
    return ", ".join(f"{n.split(' ')[0]}{separator}{n.split(' ')[1] if ' ' in n else 'string'}" for n in names)


RECORD = f"{_fields(LEVEL, ' ')}, examples array<struct<{_fields(EXAMPLE, ':')}>>, adversarial_examples array<struct<{_fields(ADVERSARIAL, ':')}>>"


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """A prompt with ``{name}`` places filled (SC59); null values become ''."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def json_schema(fields: Mapping[str, object], name: str = "record") -> str:
    """A strict JSON schema from {field: type | [enum values] | nested mapping | (item,) for arrays} (SC60)."""
    import json

    def of(spec):
        if isinstance(spec, Mapping):
            return {"type": "object", "properties": {k: of(v) for k, v in spec.items()}, "required": list(spec), "additionalProperties": False}
        if isinstance(spec, tuple):
            return {"type": "array", "items": of(spec[0])} | ({"minItems": spec[1], "maxItems": spec[1]} if len(spec) > 1 else {})
        if isinstance(spec, list):
            return {"type": "string", "enum": spec}
        return {"type": spec}

    return json.dumps({"type": "json_schema", "name": name, "strict": True, "schema": of(fields)}, ensure_ascii=False)


def build_requests(df: DataFrame, custom_id: Column, prompt: Column, model: str, schema: str | None = None, url: str = "/v1/responses") -> DataFrame:
    """One request line per row (SNK5, UD21): column ``value``, ready for write.text."""
    body = [F.lit(model).alias("model"), prompt.alias("input")]
    if schema:
        body.append(F.struct(F.parse_json(F.lit(schema)).alias("format")).alias("text"))
    return df.select(F.to_json(F.struct(custom_id.alias("custom_id"), F.lit("POST").alias("method"), F.lit(url).alias("url"), F.struct(*body).alias("body"))).alias("value"))


#: Branches: the prefix of ids of rows without one, the column of the example, and the instruction.
BRANCHES = {
    "core": ("core_v2_", "example", "Describe the idiom {idiom} and write labelled examples. Meaning: {meaning}. Known example: {example}"),
    "modern": ("modern_v1_", "example", "Decide whether the modern expression {idiom} is an idiom, then describe it. Meaning: {meaning}. Known example: {example}"),
    "generated": ("generated_v1_", "example_raw", "Check the proposed idiom {idiom}, reject what is literal or unknown, then describe it. Meaning: {meaning}. Known example: {example}"),
}


def branch_requests(df: DataFrame, branch: str, model: str, schema: str | None = None, instruction: str | None = None, position: str = "_pos") -> DataFrame:
    """Request lines of an enrichment branch (UD21): idiom id as custom id, else the branch's prefix and the row's position; null texts are ''."""
    prefix, example, own = BRANCHES[branch]
    text = fill_template(instruction or own, {"idiom": F.col("idiom_canonical"), "meaning": F.col("idiom_canonical_meaning"), "example": F.col(example)})
    custom_id = F.coalesce(F.col("idiom_id").cast("string"), F.concat(F.lit(prefix), F.col(position).cast("string")))
    return build_requests(df, custom_id, text, model, schema)


def generation_requests(exclusions: DataFrame, instruction: str, model: str, schema: str | None = None, category: str = "category", listed: str = "excluded") -> DataFrame:
    """One request for each category, naming the idioms not to propose (UD21, SL8). ``exclusions``: (category, array of idioms)."""
    text = fill_template(instruction, {"category": F.col(category), "excluded": F.array_join(F.col(listed), ", ")})
    return build_requests(exclusions, F.concat(F.lit("missing_idioms_"), F.col(category), F.lit("_v1")), text, model, schema)


def output_text(response: Column, first_only: bool = False) -> Column:
    """The text of the first output_text item of a message; or simply of the first item (SC41). Null where there is none."""
    output = response["body"]["output"]
    if first_only:
        return F.get(F.get(output, F.lit(0))["content"], F.lit(0))["text"]
    items = F.flatten(F.transform(F.filter(output, lambda o: o["type"] == "message"), lambda o: o["content"]))
    return F.get(F.filter(items, lambda c: c["type"] == "output_text"), F.lit(0))["text"]


def parse_results(lines: DataFrame, record: str = RECORD, value: str = "value", first_only: bool = False) -> DataFrame:
    """Result lines -> custom_id, model, record (null where nothing can be parsed), parsed (UD7, UD15).

    Text around a JSON object is cut away, and what is no JSON is read tolerantly; ids are trimmed.
    """
    outer = lines.select(F.from_json(value, RESULT).alias("r")).where("r is not null")
    text = T.with_json(outer, output_text(F.col("r.response"), first_only), "json").select(T.safe("r.custom_id").alias("custom_id"), F.col("r.response.body.model").alias("model"), "json")
    out = text.select("custom_id", "model", F.from_json("json", record, {"mode": "PERMISSIVE"}).alias("record"), F.col("json").isNotNull().alias("parsed"))
    return out.withColumn("record", F.when(F.col("parsed"), F.col("record")))


def parse_counts(parsed: DataFrame) -> DataFrame:
    """(UD7)"""
    return parsed.agg(F.count_if("parsed").alias("parsed"), F.count_if(~F.col("parsed")).alias("failed"))


def list_json(c: Column) -> Column:
    """A list as JSON text, null as [] (SC42)."""
    return F.coalesce(F.to_json(c), F.lit("[]"))


def _level(idiom_id: Column) -> list[Column]:
    r = F.col("record")
    names = [n.split(" ")[0] for n in LEVEL]
    lists = ("hard_negative_idioms", "meaning_paraphrases_en", "meaning_paraphrases_ar")
    own = [list_json(r[n]).alias(n) if n in lists else r[n].alias({"explanation_en": "idiom_level_explanation_en", "explanation_ar": "idiom_level_explanation_ar"}.get(n, n)) for n in names]
    return [idiom_id.alias("idiom_id"), *own]


ROW = ("context_type", "source_style", "idiom_surface", "idiom_in_example", "idiom_in_example_arabic", "idiom_in_example_meaning_en", "idiom_in_example_meaning_arabic", "is_example_idiom", "example_usage_label", "explanation_en", "explanation_ar", "expected_label", "adversarial_type")


def _rows_of(parsed: DataFrame, level: list[Column], *families: Column) -> DataFrame:
    """Level columns and the rows of all families (arrays of one struct type): one pass, so that records are parsed once."""
    every = F.concat(*[F.coalesce(f, F.array().cast(_ROWS)) for f in families])
    out = parsed.where("parsed").select(*level, F.explode(every).alias("__row"))
    return out.select(*[c for c in out.columns if c != "__row"], "__row.*")


_FIELDS = ("row_type", "at int", "context_type", "source_style", "idiom_surface", "idiom_in_example", "idiom_in_example_arabic", "idiom_in_example_meaning_en", "idiom_in_example_meaning_arabic", "is_example_idiom boolean", "example_usage_label", "explanation_en", "explanation_ar", "expected_label", "adversarial_type", "minimal_pair_id", "is_adversarial_example boolean")
_ROWS = f"array<struct<{_fields(_FIELDS, ':')}>>"


def _row(values: Mapping[str, Column]) -> Column:
    """One row struct of _FIELDS; null texts become '' unless they are given as null literals."""
    return F.struct(*[values[f.split(" ")[0]].cast(f.split(" ")[1] if " " in f else "string").alias(f.split(" ")[0]) for f in _FIELDS])


def flatten_core(parsed: DataFrame, idiom_id: Column | None = None) -> DataFrame:
    """Main and adversarial rows of each record with ids, flags and labels (UD3, SC20, SC44).

    Main rows expect their own label; adversarial ones are numbered in order, take the expected label as their own and carry no
    surface and no pair. Records without examples of a kind give no rows of it.
    """
    key = F.col("custom_id") if idiom_id is None else idiom_id
    level = [*_level(key), T.short_id("paraphrase_", key, F.lit("paraphrase"), separator="||", lower=False).alias("paraphrase_group_id"), F.coalesce("model", F.lit("")).alias("enrichment_model")]
    text = lambda e, *names: {c: F.coalesce(e[c], F.lit("")) for c in names}
    shared = ("idiom_in_example", "idiom_in_example_arabic", "idiom_in_example_meaning_en", "idiom_in_example_meaning_arabic", "explanation_en", "explanation_ar")
    null = F.lit(None)

    def main(e, i):
        label = F.coalesce(e["example_usage_label"], F.lit(""))
        pair = T.short_id("pair_", key, F.coalesce(e["context_type"], F.lit("")), separator="||", lower=False)
        return _row(text(e, *shared, "context_type", "source_style", "idiom_surface") | {"row_type": F.lit("main_example"), "at": i, "is_example_idiom": e["is_example_idiom"], "example_usage_label": label, "expected_label": label, "adversarial_type": F.lit(""), "minimal_pair_id": pair, "is_adversarial_example": F.lit(False)})

    def adversarial(e, i):
        label = F.coalesce(e["expected_label"], F.lit(""))
        return _row(text(e, *shared, "adversarial_type") | {"row_type": F.concat(F.lit("adversarial_example_"), (i + 1).cast("string")), "at": i, "context_type": F.lit("adversarial"), "source_style": F.coalesce(e["source_style"], F.lit("synthetic_adversarial")), "idiom_surface": null, "is_example_idiom": T.label_bool(label), "example_usage_label": label, "expected_label": label, "minimal_pair_id": null, "is_adversarial_example": F.lit(True)})

    return _rows_of(parsed, level, F.transform("record.examples", main), F.transform("record.adversarial_examples", adversarial))


def flatten_extended(parsed: DataFrame, example_field: str = "idiom_in_example") -> DataFrame:
    """Rows of the extended branches (UD4, UD5): a record that is no idiom gives one ``idiom_only`` row.

    ``at`` is a row's place in its list. ``example_field`` names where the example text is ("example" in the generated branch). Adversarial rows keep an empty usage
    label, and the idiom as their surface.
    """
    r = F.col("record")
    blank = {c: (F.lit(None).cast("boolean") if c == "is_example_idiom" else F.lit("")) for c in ROW}
    kind = f"array<struct<row_type:string, at:int, {', '.join(c + (':boolean' if c == 'is_example_idiom' else ':string') for c in ROW)}>>"
    here = lambda e, names: {c: F.coalesce(e[c], F.lit("")) for c in names}
    shared = ("source_style", "idiom_in_example_arabic", "idiom_in_example_meaning_en", "idiom_in_example_meaning_arabic", "explanation_en", "explanation_ar")

    def row(row_type: str, at: Column, values: dict[str, Column]) -> Column:
        return F.struct(F.lit(row_type).alias("row_type"), at.cast("int").alias("at"), *[(values[c] if c in values else v).alias(c) for c, v in blank.items()])

    def main(e, i):
        return row("main_example", i, here(e, (*shared, "context_type", "idiom_surface", "example_usage_label")) | {"idiom_in_example": F.coalesce(e[example_field], F.lit("")), "is_example_idiom": e["is_example_idiom"]})

    def adversarial(e, i):
        return row("adversarial_example", i, here(e, (*shared, "expected_label", "adversarial_type")) | {"context_type": F.lit("adversarial"), "idiom_surface": F.coalesce(r["idiom_canonical"], F.lit("")), "idiom_in_example": F.coalesce(e[example_field], F.lit(""))})

    # all kinds in one pass: a union of them would parse every record once for each
    listed = F.concat(*[F.coalesce(f.cast(kind), F.array().cast(kind)) for f in (F.transform(r["examples"], main), F.transform(r["adversarial_examples"], adversarial))])
    every = F.when(F.coalesce(r["is_idiom"], F.lit(False)), listed).otherwise(F.array(row("idiom_only", F.lit(0), {})).cast(kind))
    out = parsed.where("parsed").select(*_level(F.col("custom_id")), F.explode(every).alias("__row"))
    return out.select(*[c for c in out.columns if c != "__row"], "__row.*")


def candidates_of(results: DataFrame, value: str = "value") -> DataFrame:
    """Generated candidates of result lines, one row each, with their place ``at`` in the answer (UD6)."""
    schema = "generation_category string, candidates array<struct<idiom_candidate:string, proposed_meaning_en:string, idiom_domain:string, idiom_register:string, slang_strength:string, regionality:string, notes:string>>"
    parsed = parse_results(results, schema, value, first_only=True).where("parsed")
    return parsed.select("custom_id", "record.generation_category", F.posexplode("record.candidates").alias("at", "c")).select("custom_id", "generation_category", "at", "c.*")


def unprocessed(df: DataFrame, log: DataFrame, key: str = "row_index") -> DataFrame:
    """Rows not in the log yet (UD12)."""
    return df.join(log.select(key).distinct(), key, "left_anti")


CORRECTED = ("idiom_surface", "idiom_in_example", "idiom_in_example_arabic", "idiom_in_example_meaning_en", "idiom_in_example_meaning_arabic", "example_usage_label", "explanation_en", "explanation_ar", "expected_label", "adversarial_type", "context_type")


def apply_verdicts(df: DataFrame, verdicts: DataFrame, key: str = "row_index", status: str = "validation_status") -> DataFrame:
    """Rows with verdicts merged (UD11, SC63).

    Verdicts: key, is_valid, correction_needed, corrected (struct of CORRECTED), error. A verdict makes a row ``verified``,
    ``invalid``, ``corrected`` or ``verification_error: ...``; rows without one stay. A main row never becomes borderline: its
    label is kept. A main row expects its label; an adversarial row's label follows what it expects.
    """
    v = verdicts.select(F.col(key).alias("__key"), "is_valid", "correction_needed", F.col("corrected").alias("__new"), F.col("error").alias("__error"))
    rows = df.join(v, df[key] == v["__key"], "left")
    done = F.col("__key").isNotNull() & F.col("__error").isNull()
    fix = done & F.coalesce("correction_needed", F.lit(False)) & F.col("__new").isNotNull()
    new_status = F.when(F.col("__key").isNull(), F.col(status)).when(F.col("__error").isNotNull(), F.concat(F.lit("verification_error: "), "__error")).when(fix, "corrected").when(F.col("is_valid"), "verified").otherwise("invalid")
    values = {c: F.when(fix, F.coalesce(F.col("__new")[c], F.col(c))).otherwise(F.col(c)) for c in CORRECTED if c in df.columns}
    main = F.col("row_type") == "main_example"
    label = F.when(main & (values["example_usage_label"] == "borderline"), F.col("example_usage_label")).otherwise(values["example_usage_label"])
    values["expected_label"] = F.when(fix & main, label).otherwise(values["expected_label"])
    values["example_usage_label"] = F.when(fix & ~main, values["expected_label"]).otherwise(label)
    return rows.withColumns({status: new_status, **values}).select(*df.columns)


def verdict_log(before: DataFrame, after: DataFrame, key: str = "row_index", columns: Sequence[str] = CORRECTED) -> DataFrame:
    """Key, status and each column before and after, for rows whose status changed (UD11)."""
    names = [c for c in columns if c in before.columns]
    old = before.select(F.col(key), F.col("validation_status").alias("status_before"), *[F.col(c).alias(f"{c}_before") for c in names])
    new = after.select(F.col(key), F.col("validation_status").alias("status_after"), *[F.col(c).alias(f"{c}_after") for c in names])
    return old.join(new, key).where(~F.col("status_before").eqNullSafe(F.col("status_after")))


def encode_texts(df: DataFrame, encoder, column: str, name: str = "embedding", batch: int = 1000) -> DataFrame:
    """Vectors of a text column by an injected ``encoder(list of texts) -> list of vectors``, in Arrow batches (UD14)."""

    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(texts), batch):
            out += [list(map(float, v)) for v in encoder(texts.iloc[at : at + batch].fillna("").tolist())]
        return pd.Series(out)

    return df.withColumn(name, encode(F.col(column)))
