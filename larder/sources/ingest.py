"""Product rows from several input shapes to canonical columns."""

from __future__ import annotations

import csv
import functools
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.scalars import as_number, number_of, strip
from larder.types import BASE_COLUMNS, COLUMNS, DOCUMENT_ONLY, NUMBER_COLUMNS, NUTRIENTS, TAG_COLUMNS

TEXT_COLUMNS = [c for c in BASE_COLUMNS if c not in (*TAG_COLUMNS, *NUMBER_COLUMNS, "no_nutrition_data")]
EXPORT_COLUMNS = [*BASE_COLUMNS, "nutriments"]


def read_documents(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """One JSON object a line: (line_text, document variant); blank lines go, others that are no object fail or are null."""
    lines = spark.read.text(path).where(strip(F.col("value")) != "")
    parsed = lines.select(F.col("value").alias("line_text"), (F.parse_json if strict else F.try_parse_json)("value").alias("document"))
    is_object = F.coalesce(F.schema_of_variant("document").startswith("OBJECT"), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("no JSON object: "), F.substring("line_text", 1, 200))).cast("variant") if strict else F.lit(None).cast("variant")
    return parsed.withColumn("document", F.when(is_object, F.col("document")).otherwise(wrong))


def read_tsv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Text cells of TSV files with a header; a quoted cell may hold tabs, doubled quotes and line breaks.

    Without ``multiline`` large files are split between tasks, and a cell can't hold a line break.
    """
    return spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", multiline).csv(path)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """A product table without blank codes; a table without ``code`` is an error."""
    rows = spark.read.parquet(path)
    if "code" not in rows.columns:
        raise ValueError("the table has no code column")
    return with_code(rows)


def with_code(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("code").isNotNull()).where(strip(F.col("code")) != "")


#: Characters that may part the cells of a sheet, and how much of it is looked at to tell which.
SEPARATORS, HEAD = ",;\t", 4096


def separator_of(head: str) -> str:
    """The commonest separator outside quotes; the earlier of :data:`SEPARATORS` among equals."""
    counts, quoted = dict.fromkeys(SEPARATORS, 0), False
    for c in head[:HEAD]:
        if c == '"':
            quoted = not quoted  # a doubled quote changes nothing
        elif not quoted and c in counts:
            counts[c] += 1
    return max(SEPARATORS, key=counts.get)


def read_sheet(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """A CSV sheet with cells as text: short rows padded, long ones cut to the header, blank ones dropped.

    Quoted cells may hold separators, doubled quotes and line breaks.  The header is the first row that isn't blank; its names are kept as they
    are, repeated and empty ones too.  Of several files each has the header as its first row.
    """
    text = "\n".join(r.value for r in spark.read.text(path).limit(500).collect()).lstrip("\ufeff")
    if not text.strip():
        raise ValueError("the sheet is empty")
    separator = separator or separator_of(text)
    records = [r for r in csv.reader(io.StringIO(text), delimiter=separator) if r]
    before = next((i for i, r in enumerate(records) if any(c.strip() for c in r)), None)
    if before is None:
        raise ValueError("the sheet has no header")
    names = records[before]
    cells = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"{c} string" for c in cells)
    reader = spark.read.schema(schema).option("sep", separator).option("escape", '"').option("multiLine", True).option("header", before == 0)
    rows = reader.csv(path)
    if before:  # blank rows stand above the header of the one file
        rows = rows.withColumn("at", F.monotonically_increasing_id()).where(F.col("at") > before).drop("at")
    filled = rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in cells])
    kept = filled.where(F.exists(F.array(*cells), lambda x: strip(x) != ""))
    return kept.select(*[F.col(c).alias(n) for c, n in zip(cells, names, strict=True)])


def decode_json_text(rows: DataFrame, column: str) -> DataFrame:
    """JSON text to variant; text that doesn't parse stays a string."""
    return rows.withColumn(column, F.coalesce(F.try_parse_json(column), F.col(column).cast("variant")))


def valid_documents(rows: DataFrame, column: str = "document") -> DataFrame:
    """(code, document) where code is a non-blank string, stripped."""
    is_text = F.schema_of_variant(F.variant_get(column, "$.code", "variant")) == "STRING"
    code = F.when(is_text, strip(F.try_variant_get(column, "$.code", "string")))
    return rows.withColumn("code", code).where(F.coalesce(F.length("code"), F.lit(0)) > 0)


def input_summary(rows: DataFrame, reason: Column, position: str, most: int = 20) -> tuple[DataFrame, DataFrame]:
    """(processed, skipped) counts, and the first skipped rows with their reason in source order."""
    marked = rows.withColumn("reason", reason)
    counts = marked.agg(F.count_if(F.col("reason").isNull()).alias("processed"), F.count_if(F.col("reason").isNotNull()).alias("skipped"))
    return counts, marked.where("reason is not null").select(F.col(position), "reason").orderBy(position).limit(most)


def localized_text(c: Column) -> Column:
    """From a list of {lang, text}: the main language's first non-blank text, else the first non-blank one, stripped."""
    filled = lambda x: F.coalesce(strip(x["text"]), F.lit("")) != ""
    main = F.filter(c, lambda x: (x["lang"] == "main") & filled(x))
    return strip(F.coalesce(F.get(main, F.lit(0))["text"], F.get(F.filter(c, filled), F.lit(0))["text"]))


def nutriment_map(c: Column, value: str = "100g", kind: str = "string") -> Column:
    """List of {name, 100g, ...} to name -> value: names stripped, nulls skipped, unknown names dropped, the last wins.

    ``kind`` is the type of the values; numbers need no detour by text.
    """
    let = lambda x, then: F.get(F.transform(F.array(x), then), F.lit(0))  # noqa: E731  evaluated once
    named = F.transform(c, lambda x: F.struct(strip(x["name"]).alias("key"), x[value].alias("value")))
    kept = F.reverse(F.filter(named, lambda x: x["value"].isNotNull() & x["key"].isin(*NUTRIENTS)))

    def last(s: Column) -> Column:
        found = F.filter(s["kept"], lambda x, i: F.array_position(s["keys"], x["key"]) == i + 1)
        return F.map_from_entries(F.transform(found, lambda x: F.struct(x["key"], number_of(x["value"], kind).alias("value"))))

    return let(kept, lambda k: let(F.struct(k.alias("kept"), F.transform(k, lambda x: x["key"]).alias("keys")), last))


def canonical(rows: DataFrame) -> DataFrame:
    """Canonical columns only, absent ones null."""
    if "code" not in rows.columns:
        raise ValueError("canonical rows need code")
    types = dict(rows.dtypes)
    wrong = [c for c in TEXT_COLUMNS if c in types and types[c] not in ("string", "void")]
    if wrong:
        raise ValueError(f"text columns hold other types: {', '.join(wrong)}")
    return rows.select(*[F.col(f"`{c}`") if c in types else F.lit(None).cast("string").alias(c) for c in COLUMNS])


def from_export(rows: DataFrame) -> DataFrame:
    """Rows of the nested table: localized names, tag arrays, list of nutriments."""
    clash = [c for c in rows.columns if c.endswith("_100g")]
    if clash:
        raise ValueError(f"nutriment columns beside nutriments: {', '.join(clash)}")
    missing = [c for c in EXPORT_COLUMNS if c not in rows.columns]
    if missing:
        raise ValueError(f"export rows lack {', '.join(missing)}")
    kind = rows.select(F.col("nutriments")[0]["100g"].alias("x")).dtypes[0][1]
    found = rows.withColumn("_n", nutriment_map(F.col("nutriments"), kind=kind))
    out = found.withColumns({c: localized_text(F.col(c)) for c in ("product_name", "ingredients_text")})
    return out.select(
        *[F.col(c).cast("string").alias(c) if c in (*NUMBER_COLUMNS, "no_nutrition_data") else F.col(c) for c in BASE_COLUMNS],
        *[F.try_element_at("_n", F.lit(n)).alias(f"{n}_100g") for n in NUTRIENTS],
    )


def _variant_text(document: str, name: str) -> Column:
    """Plain text, or the pick from a list of {lang, text}; stripped, blank text is null."""
    plain = F.nullif(strip(F.try_variant_get(document, f"$.{name}", "string")), F.lit(""))
    listed = F.try_variant_get(document, f"$.{name}", "array<struct<lang:string,text:string>>")
    return F.when(listed.isNotNull(), localized_text(listed)).otherwise(plain)


def _variant_tags(document: str, name: str) -> Column:
    listed = F.try_variant_get(document, f"$.{name}", "array<string>")
    return F.coalesce(listed, F.split(F.try_variant_get(document, f"$.{name}", "string"), ","))


def from_documents(rows: DataFrame, document: str = "document") -> DataFrame:
    """Full documents (variant) that are known to fit: plain or localized texts, tag lists, nutriments by name.

    What nutriments has, nulls too, overrides plain columns.  Rows of unknown shape go through ``dispatch``.
    """
    found = rows.withColumn("_n", F.try_variant_get(document, "$.nutriments", "map<string,variant>"))
    value = lambda v: F.coalesce(F.try_variant_get(v, "$", "double"), as_number(F.try_variant_get(v, "$", "string")))
    number = lambda c: value(
        F.when(F.map_contains_key("_n", c), F.try_element_at("_n", F.lit(c))).otherwise(F.try_variant_get(document, f'$["{c}"]', "variant"))
    )
    columns = []
    for c in BASE_COLUMNS:
        if c == "code":
            columns.append(F.col("code"))
        elif c in TAG_COLUMNS:
            columns.append(_variant_tags(document, c).alias(c))
        elif c in ("product_name", "ingredients_text"):
            columns.append(_variant_text(document, c).alias(c))
        else:
            columns.append(F.try_variant_get(document, f"$.{c}", "string").alias(c))
    return found.select(*columns, *[number(f"{n}_100g").alias(f"{n}_100g") for n in NUTRIENTS])


def _shape(document: Column) -> Column:
    """Input shape of a raw JSON object, or why it has none, as (contract, reason); one of them is null."""
    keys = F.map_keys(F.from_json(F.to_json(document), "map<string,string>"))
    names = lambda cs: F.array(*[F.lit(c) for c in cs])
    kind = lambda c: F.coalesce(F.schema_of_variant(F.try_variant_get(document, f"$.{c}", "variant")), F.lit("VOID"))
    text = lambda c: looks_structured(F.try_variant_get(document, f"$.{c}", "string"))
    marked = F.arrays_overlap(keys, names(DOCUMENT_ONLY))
    payload = F.arrays_overlap(keys, names(["nutriments", "product_name", "ingredients_text", *TAG_COLUMNS]))
    nutriments = kind("nutriments")
    by_name = nutriments.startswith("OBJECT")
    lacks = F.array_except(names(EXPORT_COLUMNS), keys)
    # the first field that only an export may hold in this form
    first = F.coalesce(
        F.when(nutriments != "VOID", "nutriments"),
        *[F.when(~kind(c).isin("VOID", "STRING") | ((kind(c) == "STRING") & text(c)), c) for c in ("product_name", "ingredients_text")],
        *[F.when(~(kind(c).isin("VOID", "STRING") | kind(c).startswith("ARRAY")) | ((kind(c) == "STRING") & text(c)), c) for c in TAG_COLUMNS],
    )
    shape = lambda name: F.struct(F.lit(name).alias("contract"), F.lit(None).cast("string").alias("reason"))
    none = lambda why: F.struct(F.lit(None).cast("string").alias("contract"), why.alias("reason"))
    return (
        F.when(marked & ~payload, none(F.lit("a document without nutriments, names or tags")))
        .when(marked & ~by_name & (nutriments != "VOID"), none(F.lit("a document's nutriments are no object")))
        .when(marked | by_name, shape("document"))
        .when((F.size(lacks) == 0) & (nutriments.startswith("ARRAY") | (nutriments == "VOID")), shape("export"))
        .when(F.size(lacks) == 0, none(F.lit("an export's nutriments are no list")))
        .when(first.isNotNull(), none(F.concat(first, F.lit(": an export lacks "), F.array_join(lacks, ", "))))
        .when(F.array_contains(keys, "code"), shape("canonical"))
        .otherwise(none(F.lit("no supported input shape")))
    )


def contract_of(document: Column) -> Column:
    """Which input shape a raw JSON object has: document, export, canonical, or null with a broken shape or none."""
    return _shape(document)["contract"]


def contract_reason(document: Column) -> Column:
    """The first reason why a raw JSON object has no input shape; null where it has one."""
    return _shape(document)["reason"]


def remap(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``columns`` maps canonical names to source names; the rest follows :func:`canonical`."""
    unknown = [c for c in columns if c not in COLUMNS]
    sources = list(columns.values())
    problems = [f"unknown column {c}" for c in unknown] + [f"no source column {s}" for s in sources if s not in rows.columns]
    problems += [f"source {s} used twice" for s in set(sources) if sources.count(s) > 1]
    problems += [f"both {c} and {s} are present" for c, s in columns.items() if c != s and c in rows.columns]
    problems += ["blank source name"] * any(not s.strip() for s in sources)
    if problems:
        raise ValueError("; ".join(problems))
    return canonical(functools.reduce(lambda df, cs: df.withColumnRenamed(cs[1], cs[0]), columns.items(), rows))


#: A quoted string of a Python literal.
_QUOTED = r"'(?:[^'\\]|\\.)*'" + r'|"(?:[^"\\]|\\.)*"'


def looks_structured(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(r"(?s)^[\[{].*[\]}]$"), F.lit(False))


def _json_string(token: Column) -> Column:
    """A quoted Python string as a JSON string."""
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    plain = F.regexp_replace(inner, r"\\(?=')", "")
    quoted = F.when(F.startswith(token, F.lit("'")), F.regexp_replace(plain, r'(?<!\\)((?:\\\\)*)"', r'$1\\"')).otherwise(plain)
    return F.concat(F.lit('"'), F.regexp_replace(quoted, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2"), F.lit('"'))


def _json_rest(piece: Column) -> Column:
    """What stands between strings: names of constants, digit groups, tuples and closing commas."""
    changes = [(r"\bNone\b", "null"), (r"\bTrue\b", "true"), (r"\bFalse\b", "false"), (r"(?<=[0-9])_(?=[0-9])", ""), (r"\(", "["), (r",?\s*\)", "]"), (r",\s*(?=[\]}])", "")]
    return functools.reduce(lambda t, ab: F.regexp_replace(t, *ab), changes, piece)


def structured_cell(c: Column) -> Column:
    """Text that holds a JSON or Python literal list or object to variant; other text is null.

    In a Python literal, quoted strings are told apart first, so that only what stands between them is rewritten.
    Text that looks structured and is neither gives null too; :func:`undecodable` tells it apart.
    """
    t = strip(c)
    strings = F.transform(F.regexp_extract_all(t, F.lit(_QUOTED), F.lit(0)), _json_string)
    rest = F.transform(F.split(t, _QUOTED, -1), _json_rest)
    as_json = F.array_join(F.zip_with(rest, strings, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(looks_structured(c), F.coalesce(F.try_parse_json(t), F.try_parse_json(as_json)))


def undecodable(c: Column) -> Column:
    """Text with the borders of a list or object that is neither JSON nor a Python literal."""
    return looks_structured(c) & structured_cell(c).isNull()


def shape_problem(rows: DataFrame) -> Column:
    """Why a row of text cells is no canonical row: nutriments, or a structured text or tag cell without the full export shape; else null."""
    if "nutriments" in rows.columns:
        return F.when(F.col("nutriments").isNotNull(), "nutriments without the other columns of an export")
    tests = [F.lit(None).cast("string")]
    for c in ("product_name", "ingredients_text", *TAG_COLUMNS):
        if c in rows.columns:
            broken = F.when(undecodable(F.col(c)), f"column '{c}' contains an unsupported raw structured string")
            tests.append(broken.when(looks_structured(F.col(c)), f"structured {c} without the other columns of an export"))
    return F.coalesce(*tests)


def decode_envelopes(lines: DataFrame, column: str, kind: str, version: int, result: str) -> DataFrame:
    """``reference_result`` (type ``result``) of JSON envelopes; another kind or version fails the job."""
    parsed = F.from_json(column, f"contract_kind string, contract_version long, reference_result {result}")
    rows = lines.select(parsed.alias("e"))
    fits = F.col("e.contract_kind").eqNullSafe(kind) & F.col("e.contract_version").eqNullSafe(version)
    wrong = F.concat_ws(" ", F.lit(f"expected {kind} {version}, got"), F.col("e.contract_kind"), F.col("e.contract_version").cast("string"))
    return rows.select(F.when(fits, F.col("e.reference_result")).otherwise(F.raise_error(wrong)).alias("r")).select("r.*")


def write_cohort(rows: DataFrame, position: str, folder: str) -> None:
    """The same products as JSON lines, TSV and Parquet, in the order of ``position``; nested columns as JSON text in the TSV."""
    ordered = rows.orderBy(position).drop(position)
    nested = [c for c, t in ordered.dtypes if t.startswith(("array", "map", "struct", "variant"))]
    flat = ordered.withColumns({c: F.to_json(F.col(f"`{c}`")) for c in nested})
    ordered.write.json(f"{folder}/jsonl", ignoreNullFields=False)
    flat.write.csv(f"{folder}/tsv", sep="\t", header=True)
    ordered.write.parquet(f"{folder}/parquet")
