"""Reading and writing a pipeline's files: TSV of recognised words, JSON artifacts, job folders, provider responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewright.functions.geometry import envelope
from quirewright.functions.text import once, paginated_markdown


def tsv_words(tsv: Column) -> Column:
    """Words of a recogniser's TSV text: level-5 rows as structs; no quoting, the twelfth field keeps its tabs.

    Short rows and the header are passed over; negative sizes count as 0; a negative confidence is null.
    """
    n = lambda f, i, kind: F.try_element_at(f, F.lit(i)).try_cast("double").cast(kind)
    fields = F.transform(F.split(tsv, r"\r?\n"), lambda line: F.split(line, "\t", 12))
    rows = F.filter(fields, lambda f: (F.size(f) >= 12) & (f[0] == "5") & (F.trim(f[11]) != ""))

    def word(f: Column, i: Column) -> Column:
        x, y = n(f, 7, "double"), n(f, 8, "double")
        box = F.array(x, y, x + F.greatest(F.lit(0.0), n(f, 9, "double")), y + F.greatest(F.lit(0.0), n(f, 10, "double")))
        confidence = n(f, 11, "double")
        return F.struct(
            F.trim(f[11]).alias("text"), box.alias("bbox"), F.when(confidence >= 0, confidence).alias("confidence"), (i + 1).alias("reading_order"),
            n(f, 2, "int").alias("page"), n(f, 3, "int").alias("block"), n(f, 4, "int").alias("paragraph"), n(f, 5, "int").alias("line"),
        )

    return F.transform(rows, word)


def tsv_text(tsv: Column) -> Column:
    """The words' text, a line for each recognised line, in first-seen order."""
    key = lambda w: F.concat_ws("/", w["page"].cast("string"), w["block"].cast("string"), w["paragraph"].cast("string"), w["line"].cast("string"))
    words = tsv_words(tsv)
    return F.array_join(F.transform(F.array_distinct(F.transform(words, key)), lambda k: F.array_join(F.transform(F.filter(words, lambda w: key(w) == k), lambda w: w["text"]), " ")), "\n")


def tsv_blocks(tsv: Column) -> Column:
    """A recogniser's lines as blocks, in first-seen order: text, bbox around the line's words, reading_order, block, paragraph, line."""
    key = lambda w: F.struct(w["page"], w["block"], w["paragraph"], w["line"])

    def block(words: Column, k: Column, i: Column) -> Column:
        own = F.filter(words, lambda w: key(w).eqNullSafe(k))
        return F.struct(
            F.array_join(F.transform(own, lambda w: w["text"]), " ").alias("text"), envelope(F.transform(own, lambda w: w["bbox"])).alias("bbox"), (i + 1).alias("reading_order"),
            F.get(own, F.lit(0))["block"].alias("block"), F.get(own, F.lit(0))["paragraph"].alias("paragraph"), F.get(own, F.lit(0))["line"].alias("line"),
        )

    return once(tsv_words(tsv), lambda ws: F.transform(F.array_distinct(F.transform(ws, key)), lambda k, i: block(ws, k, i)))


def layout_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a PDF text layer's XHTML (pages of flows of blocks of lines of words with their boxes): file, width, height, words.

    A word has its text, box, and the numbers of its block and line in the page, from 1; words without text are dropped.
    """
    box = "_xMin double, _yMin double, _xMax double, _yMax double"
    schema = f"_width double, _height double, flow array<struct<block: array<struct<line: array<struct<word: array<struct<_VALUE: string, {box.replace('double', ': double').replace(' :', ':')}>>>>>>>>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    blocks = F.flatten(F.transform("flow", lambda f: f["block"]))

    def words(b: Column, i: Column) -> Column:
        of_line = lambda x, j: F.transform(x["word"], lambda w: F.struct(F.trim(w["_VALUE"]).alias("text"), F.array(w["_xMin"], w["_yMin"], w["_xMax"], w["_yMax"]).alias("bbox"), (i + 1).alias("block"), (j + 1).alias("line")))
        return F.flatten(F.transform(b["line"], of_line))

    found = F.flatten(F.transform(blocks, words))
    return pages.select(F.input_file_name().alias("file"), F.col("_width").alias("width"), F.col("_height").alias("height"), F.filter(found, lambda w: w["text"] != "").alias("words"))


def union_of_rows(parts: list[DataFrame]) -> DataFrame | None:
    """Rows of several tables with all their columns, in first-seen order; none without tables."""
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def source_files(spark: SparkSession, folder: str, pattern: str = "*.[pP][dD][fF]", outside: str | None = None) -> DataFrame:
    """Files below a folder: path, relative key without suffix, name, size and digest; those under ``outside`` are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    if outside:
        files = files.filter(~F.regexp_replace("path", r"^file:/+", "/").startswith(outside.rstrip("/") + "/"))
    name = F.element_at(F.split("path", "/"), -1)
    relative = F.regexp_replace(F.substring_index("path", folder.rstrip("/") + "/", -1), r"\.[^./]*$", "")
    return files.select("path", relative.alias("job"), name.alias("file_name"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("content_sha256"))


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """JSON files: path, digest of the exact bytes, text, and whether it is an object."""
    files = spark.read.format("binaryFile").load(path)
    text = F.decode("content", "UTF-8")
    kind = F.schema_of_variant(F.try_parse_json(text))
    return files.select("path", F.sha2("content", 256).alias("sha256"), text.alias("text"), F.coalesce(kind.startswith("OBJECT"), F.lit(False)).alias("is_object"))


def log_lines(spark: SparkSession, path: str, key: str = "page") -> tuple[DataFrame, DataFrame]:
    """A JSON-lines log as (records, issues): record text by file and line number; blank lines are skipped, bad ones are issues."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"), "value").filter(F.trim("value") != "")
    v = F.try_parse_json("value")
    page = F.try_variant_get(v, f"$.{key}", "int")
    lines = lines.select("file", "line", "value", page.alias(key), F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)).alias("object"))
    good = F.col("object") & (F.col(key) > 0)
    code = F.when(~F.col("object"), "not_an_object").otherwise("bad_page")
    return lines.filter(good).drop("object"), lines.filter(~F.coalesce(good, F.lit(False))).select("file", "line", code.alias("code"))


def provider_pages(response: Column) -> Column:
    """Pages of a hosted recogniser's saved response (JSON text): top-level children that are pages, with their blocks' text, html and box.

    The response may lie in a ``result`` member; a response without pages but with markdown has one page a rule line apart.
    """
    child = "array<struct<block_type:string,page:int,html:string,markdown:string,text:string,bbox:array<double>,children:array<struct<block_type:string,html:string,text:string,markdown:string,bbox:array<double>>>>>"
    schema = f"struct<children:{child},markdown:string,page_count:int,result:struct<children:{child},markdown:string,page_count:int>>"
    r = F.from_json(response, schema)
    children = F.coalesce(r["children"], r["result"]["children"])
    markdown = F.coalesce(r["markdown"], r["result"]["markdown"])
    pick = lambda b: F.coalesce(*[F.when(F.trim(b[x]) != "", b[x]) for x in ("text", "markdown", "html")])
    pages = F.filter(children, lambda c: c["block_type"] == "Page")

    def page(c: Column, i: Column) -> Column:
        blocks = F.filter(F.transform(c["children"], lambda b: F.struct(b["block_type"].alias("label"), pick(b).alias("text"), b["bbox"].alias("bbox"))), lambda b: b["text"].isNotNull())
        return F.struct(F.coalesce(c["page"], i + 1).alias("page"), pick(c).alias("text"), blocks.alias("blocks"))

    fallback = F.transform(paginated_markdown(markdown), lambda t, i: F.struct((i + 1).alias("page"), t.alias("text"), F.lit(None).cast("array<struct<label:string,text:string,bbox:array<double>>>").alias("blocks")))
    return F.when(F.size(pages) > 0, F.transform(pages, page)).otherwise(fallback)


#: Pages of one part of a combined text.
PAGES_A_PART = 256


def page_texts(pages: DataFrame, document: list[str], page: str = "page", text: str = "text") -> DataFrame:
    """Each document's text in page order with a line before each page: document keys, part_no, text.

    A part holds the pages of one stretch of ``PAGES_A_PART`` numbers, so that no row grows with a document; its parts
    joined by line ends are the document's text.
    """
    row = F.struct(F.col(page).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    joined = F.transform(F.array_sort(F.collect_list(row)), lambda x: F.concat(F.lit("--- Page "), x["p"].cast("string"), F.lit(" ---\n"), x["t"]))
    return pages.groupBy(*document, F.floor((F.col(page) - 1) / PAGES_A_PART).cast("int").alias("part_no")).agg(F.array_join(joined, "\n").alias("text"))


def published(df: DataFrame, path: str, kind: str = "json") -> None:
    """Written whole or not at all, by Spark's commit protocol."""
    {"json": df.write.mode("overwrite").json, "csv": df.write.mode("overwrite").option("header", True).csv, "text": df.write.mode("overwrite").text, "parquet": df.write.mode("overwrite").parquet}[kind](path)
