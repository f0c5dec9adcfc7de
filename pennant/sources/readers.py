"""Source files to raw frames: delimited text, archives, XML, feeds, nested JSON, verified artifacts.

Fetching over a network isn't part of this; readers start from files.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from pennant.functions.clean import snake_case
from pennant.sources.sinks import clean_names

#: Guards against hostile archives.
MAX_MEMBERS, MAX_BYTES, MAX_RATIO = 10_000, 1 << 30, 200


def csv_with_header(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, under clean names."""
    df = spark.read.csv(path, header=True, inferSchema=False)
    return df.toDF(*clean_names(df.columns))


def csv_without_header(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    return spark.read.schema(StructType([StructField(f, StringType()) for f in fields])).csv(path)


def csv_or_quarantine(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that don't fit the schema with the file they are in."""
    kept = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    df = spark.read.schema(kept).csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record", enforceSchema=True).withColumn("_file", F.input_file_name())
    # A column that isn't read isn't checked either: this always holds, but makes both sides read all of them.
    df = df.filter(F.length(F.concat_ws("", *[F.col(f.name).cast("string") for f in schema.fields])) >= 0)
    return df.filter("_corrupt_record is null").drop("_corrupt_record", "_file"), df.filter("_corrupt_record is not null").select("_file", "_corrupt_record")


def zip_members(spark: SparkSession, path: str, fields: Sequence[str], suffix: str = ".csv") -> DataFrame:
    """Rows of all delimited members of zip archives, with archive and member; unsafe archives raise."""
    return unzipped(spark.read.format("binaryFile").load(path), fields, suffix)


def unzipped(archives: DataFrame, fields: Sequence[str], suffix: str = ".csv") -> DataFrame:
    """zip_members of archives that are at hand as path and content."""
    fields = clean_names(fields)

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    members = z.infolist()
                    total = sum(m.file_size for m in members)
                    if len(members) > MAX_MEMBERS or total > MAX_BYTES or total > MAX_RATIO * max(1, len(content)):
                        raise ValueError(f"{name}: archive is too large")
                    for m in members:
                        if m.filename.startswith("/") or ".." in m.filename.split("/"):
                            raise ValueError(f"{name}: member {m.filename} leaves the archive")
                        if m.filename.lower().endswith(suffix):
                            with z.open(m) as f:
                                rows = pd.read_csv(f, dtype=str, keep_default_na=False)
                            rows.columns = clean_names(list(rows.columns))
                            rows = rows.reindex(columns=fields)
                            yield rows.assign(_archive=name, _member=m.filename)

    schema = ", ".join(f"{c} string" for c in [*fields, "_archive", "_member"])
    return archives.select("path", "content").mapInPandas(unpack, schema)


def many_files(spark: SparkSession, pattern: str, fields: Sequence[str]) -> DataFrame:
    """All files of a pattern, with the file's name."""
    return csv_without_header(spark, pattern, fields).withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))


#: What stands before every game of an event file but the first.
GAME_START = "\nid,"


def event_records(spark: SparkSession, pattern: str) -> DataFrame:
    """Record-typed event files: _file, line, kind, fields c1.. and game_id, games apart by their id records.

    A file is read in parts that end where an id record begins, so no row holds
    more than one game and many tasks share a large file. line grows along a file;
    in its first split it is the number of the line. An id record without an id
    begins a game without one.
    """
    text = spark.read.text(pattern, lineSep=GAME_START).select(F.input_file_name().alias("_file"), F.input_file_block_start().alias("block"), "value")
    games = text.mapInArrow(_games, "_file string, first long, value string").withColumn("value", F.regexp_replace("value", "\r", ""))
    record = lambda c: F.from_csv(c, ", ".join(f"c{k} string" for k in range(12)))
    games = games.withColumn("_id", record(F.substring_index("value", "\n", 1)))
    games = games.select("_file", "first", F.when(F.col("_id.c0") == "id", F.col("_id.c1")).alias("game_id"), "value")
    lines = games.select("_file", "first", "game_id", F.posexplode(F.split("value", "\n")).alias("at", "row")).filter("row <> ''")
    lines = lines.select("_file", (F.col("first") + F.col("at")).alias("line"), record(F.col("row")).alias("c"), "game_id")
    return lines.select("_file", "line", F.col("c.c0").alias("kind"), *[f"c.c{k}" for k in range(1, 12)], "game_id")


def _games(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of files (_file, block: where their split begins, value) with the id record's name that cutting took, and first: numbers of their first lines, 256 apart for each byte before the split."""
    held, upto = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        files, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        name = files.indices.to_numpy()
        here = [(files.dictionary[int(name[k])].as_py(), int(block[k])) for k in (0, -1)]
        fresh = np.concatenate([[here[0] != held], (name[1:] != name[:-1]) | (block[1:] != block[:-1])])
        cut = pc.if_else(pa.array(fresh & (block == 0)), batch.column(2), pc.binary_join_element_wise(GAME_START[1:], batch.column(2), ""))
        # A quoted id record begins a game, too.
        parts = pc.split_pattern(cut, '\n"id"')
        row, value = pc.list_parent_indices(parts).to_numpy(), parts.flatten()
        inner = np.concatenate([[False], row[1:] == row[:-1]])
        value = pc.if_else(pa.array(inner), pc.binary_join_element_wise('"id"', value, ""), value)
        lines = pc.count_substring(value, "\n").to_numpy().astype(np.int64) + 1
        before = np.cumsum(lines) - lines
        begins = np.flatnonzero(fresh[row] & ~inner)
        of = np.searchsorted(begins, np.arange(len(row)), side="right")
        first = before - np.concatenate([[-upto], before[begins]])[of]
        held, upto = here[1], int(first[-1] + lines[-1])
        yield pa.RecordBatch.from_arrays([pc.take(batch.column(0), pa.array(row)), pa.array((block[row] << 8) + first), value], names=["_file", "first", "value"])


def plays_of(records: DataFrame) -> DataFrame:
    """Play records with typed inning, side and a play number inside their game."""
    from pyspark.sql import Window

    w = Window.partitionBy("game_id").orderBy("line")
    plays = records.filter("kind = 'play'").withColumn("play", F.row_number().over(w))
    return plays.select("game_id", "play", F.col("c1").try_cast("int").alias("inning"), F.col("c2").try_cast("int").alias("home"), F.col("c3").alias("batter"), F.col("c4").alias("count"), F.col("c5").alias("pitches"), F.col("c6").alias("event"))


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "").schema(schema).load(path)


def feed_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS feeds: key (guid, else SHA-256 of the link), title, link, published; items with neither are left out."""
    items = spark.read.format("xml").option("rowTag", "item").option("ignoreNamespace", "true").schema("guid string, title string, link string, pubDate string, description string").load(path)
    key = F.coalesce(F.nullif(F.trim("guid"), F.lit("")), F.sha2(F.nullif(F.trim("link"), F.lit("")), 256))
    return items.select(key.alias("key"), "title", "link", F.col("pubDate").alias("published"), "description").filter("key is not null")


def flatten(df: DataFrame, column: str, schema: str, path: str, fields: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Rows of a JSON document's array at `path`: fields maps output names to dotted paths in an element."""
    parsed = df.select(*keep, F.from_json(column, schema).alias("_d"))
    rows = parsed.select(*keep, F.posexplode(f"_d.{path}" if path else "_d").alias("_position", "_e"))
    return rows.select(*keep, "_position", *[F.col(f"_e.{p}").alias(n) for n, p in fields.items()])


def flatten_map(df: DataFrame, column: str, schema: str, path: str, keep: Sequence[str], key: str = "key") -> DataFrame:
    """Rows of a JSON document's map at `path`, with scalar fields in snake case."""
    parsed = df.select(*keep, F.from_json(column, schema).alias("_d"))
    rows = parsed.select(*keep, F.explode(f"_d.{path}").alias(key, "_e"))
    fields = rows.schema["_e"].dataType.fields
    return rows.select(*keep, key, *[F.col(f"_e.{f.name}").alias(snake_case(f.name)) for f in fields if not isinstance(f.dataType, (StructType, ArrayType))])


def scalars(df: DataFrame, struct: str, keep: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """Atomic fields of a struct column, and those of its structs with their name as a prefix."""
    out: list[Column] = []
    for f in df.schema[struct].dataType.fields:
        if isinstance(f.dataType, StructType):
            out += [F.col(f"{struct}.{f.name}.{g.name}").alias(f"{prefix}{snake_case(f.name)}_{snake_case(g.name)}") for g in f.dataType.fields if not isinstance(g.dataType, (StructType, ArrayType))]
        elif not isinstance(f.dataType, ArrayType):
            out.append(F.col(f"{struct}.{f.name}").alias(f"{prefix}{snake_case(f.name)}"))
    return df.select(*keep, *out)


def line_scores(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """Innings by side: inning, side, runs, hits, errors."""
    side = "struct<runs:int,hits:int,errors:int>"
    rows = flatten(df, column, f"struct<innings:array<struct<num:int,home:{side},away:{side}>>>", "innings", {"inning": "num", "home": "home", "away": "away"}, keep)
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}.runs").alias("runs"), F.col(f"{s}.hits").alias("hits"), F.col(f"{s}.errors").alias("errors")) for s in ("home", "away")])
    return rows.select(*keep, "inning", F.explode(sides).alias("_s")).select(*keep, "inning", "_s.*")


def outcomes(df: DataFrame, keep: Sequence[str], **lists: str) -> DataFrame:
    """Parallel JSON-text lists zipped by index; short lists give nulls."""
    arrays = [F.from_json(c, "array<string>").alias(n) for n, c in lists.items()]
    return df.select(*keep, F.posexplode(F.arrays_zip(*[a for a in arrays])).alias("position", "_z")).select(*keep, "position", *[F.col(f"_z.{n}") for n in lists])


def candles(df: DataFrame, parts: Mapping[str, Sequence[str]], keep: Sequence[str]) -> DataFrame:
    """Prefixed sub-objects of price candles; absent keys are null."""
    return df.select(*keep, *[F.col(f"{part}.{f}").alias(f"{part}_{f}") for part, fields in parts.items() for f in fields])


def last_page_wins(pages: Sequence[DataFrame], key: str) -> DataFrame:
    """Paged result sets as one; of rows with one key the latest page's stays."""
    from pennant.operators.sets import stacked

    rows = stacked([p.withColumn("_page", F.lit(k)) for k, p in enumerate(pages)])
    best = rows.groupBy(key).agg(F.max("_page").alias("_page"))
    return rows.join(best, [key, "_page"]).dropDuplicates([key]).drop("_page")


def time_chunks(spark: SparkSession, first: str, last: str, days: int) -> DataFrame:
    """Ranges of `days` days from first to last, both ends included."""
    starts = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr(f"interval {days} days"))).alias("start"))
    return starts.select("start", F.least(F.date_add("start", days - 1), F.lit(last).cast("date")).alias("end"))


def verified_ndjson(spark: SparkSession, path: str, digests: Mapping[str, str], schema: str) -> DataFrame:
    """Rows of gzip NDJSON artifacts whose SHA-256 is as recorded; any other content raises before a row is parsed."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("digest"))
    known = spark.createDataFrame(list(digests.items()), "name string, recorded string")
    wrong = files.join(known, "name", "left").filter("recorded is null or recorded <> digest")
    bad = [r["name"] for r in wrong.limit(20).collect()]
    if bad:
        raise ValueError(f"artifacts differ from their record: {bad}")
    return spark.read.schema(schema).json(path)


def split_datasets(df: DataFrame, name: str, datasets: Sequence[str]) -> dict[str, DataFrame]:
    """One stream of documents apart by the dataset they name."""
    return {d: df.filter(F.col(name) == d) for d in datasets}


def flatten_groups(df: DataFrame, column: str, schema: str, path: str, rows: str, group: Mapping[str, str], fields: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Rows of the arrays `rows` inside each entry of a map or array at `path`, with the entry's fields beside each row.

    The key of a map's entry is the column `entry`.
    """
    parsed = df.select(*keep, F.from_json(column, schema).alias("_d"))
    entries = parsed.select(*keep, F.explode(f"_d.{path}").alias("entry", "_g") if isinstance(_at(parsed.schema["_d"].dataType, path), MapType) else F.explode(f"_d.{path}").alias("_g"))
    names = [c for c in entries.columns if c != "_g"]
    rows_ = entries.select(*names, *[F.col(f"_g.{p}").alias(n) for n, p in group.items()], F.explode(f"_g.{rows}").alias("_e"))
    return rows_.select(*names, *group, *[F.col(f"_e.{p}").alias(n) for n, p in fields.items()])


def _at(type_: StructType, path: str):
    for name in path.split("."):
        type_ = type_[name].dataType
    return type_


def stat_columns(df: DataFrame, column: str, keep: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A JSON map of statistics as columns in snake case, null where a row has none; no shuffle, as the names are given."""
    stats = F.from_json(column, "map<string,string>")
    return df.select(*keep, *[F.try_element_at(stats, F.lit(n)).alias(snake_case(n)) for n in names])


def stat_names(df: DataFrame, column: str) -> list[str]:
    """The distinct names in a JSON map column: few, as each becomes a column."""
    names = df.select(F.explode(F.map_keys(F.from_json(column, "map<string,string>"))).alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


def complete_scopes(tables: Mapping[str, DataFrame], scope: str) -> DataFrame:
    """Scopes that every one of the tables has; a scope that one of them lacks isn't loaded yet."""
    seen = None
    for name, df in tables.items():
        part = df.select(F.col(scope), F.lit(name).alias("_table")).distinct()
        seen = part if seen is None else seen.unionByName(part)
    return seen.groupBy(scope).agg(F.count("*").alias("_n")).filter((F.col("_n") == len(tables)) & F.col(scope).isNotNull()).select(scope)


def xml_lists(spark: SparkSession, path: str, row_tag: str, lists: Mapping[str, str], keys: Mapping[str, str]) -> dict[str, DataFrame]:
    """Each list of a nested XML row as a table: lists maps list.element to the element's fields, keys the row's own attributes to types."""
    fields = [f"{k} {v}" for k, v in keys.items()] + [f"{n.split('.')[0]} struct<{n.split('.')[1]}:array<struct<{s}>>>" for n, s in lists.items()]
    rows = xml_rows(spark, path, row_tag, ", ".join(fields))
    return {n.split(".")[0]: rows.select(*keys, F.posexplode(n).alias("position", "_e")).select(*keys, "position", "_e.*") for n in lists}


#: The lists of a box score beside its players, container and element.
BOX_LISTS = {"doubles": "double", "triples": "triple", "homeruns": "homerun", "stolenbases": "stolenbase", "doubleplays": "doubleplay", "tripleplays": "tripleplay", "sacbunts": "sacbunt"}
PLAYER = ("id", "lname", "fname", "slot", "seq", "pos")


def box_tables(documents: DataFrame, column: str, columns: Mapping[str, Sequence[str]], lists: Mapping[str, str] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Tables of box scores in XML: game (with linescore_ columns), batting, fielding (a player may have several), pitching, and one for each supplementary list.

    A document is any number of <boxscore> elements one after the other, without a
    root; every element becomes a row before it is parsed. An ampersand that
    begins no entity is a character. columns names each table's attributes
    (linescore: those of the line score); all values are text, absent ones null.
    keep writes the parsed rows and reads them back: without it every table that is
    used parses all documents anew.
    """
    lists = dict(lists or BOX_LISTS)
    text = F.regexp_replace(F.col(column), r"&(?!(?:[A-Za-z]+|#[0-9]+|#x[0-9A-Fa-f]+);)", "&amp;")
    boxes = documents.select(F.explode(F.split(text, r"(?=<boxscore[\s>])")).alias("_x")).filter(F.col("_x").rlike(r"^<boxscore[\s>]"))
    record = lambda names: f"struct<{','.join(f'`{n}`:string' for n in names)}>"
    player = f"struct<{','.join(f'`{n}`:string' for n in PLAYER)},batting:array<{record(columns['batting'])}>,fielding:array<{record(columns['fielding'])}>>"
    schema = ", ".join(
        [
            *[f"`{n}` string" for n in columns["game"]], f"linescore {record(columns['linescore'])}", f"players array<struct<team:string,player:array<{player}>>>",
            f"pitching array<struct<team:string,pitcher:array<{record(columns['pitching'])}>>>", *[f"{box} struct<{one}:array<{record(columns[one])}>>" for box, one in lists.items()],
        ]
    )
    rows = boxes.select(F.from_xml("_x", schema, {"attributePrefix": "", "rowTag": "boxscore"}).alias("b")).select("b.*")
    rows = keep(rows) if keep else rows
    game = rows.select(*columns["game"], *[F.col(f"linescore.{n}").alias(f"linescore_{n}") for n in columns["linescore"]])
    sides = rows.select("game_id", F.explode("players").alias("s")).select("game_id", "s.team", F.explode("s.player").alias("p"))
    who = ["game_id", "team", *[F.col(f"p.{n}").alias("start_pos" if n == "pos" else n) for n in PLAYER]]
    own = lambda kind: sides.select(*who, F.explode(f"p.{kind}").alias("e")).select("game_id", "team", *["start_pos" if n == "pos" else n for n in PLAYER], *[F.col(f"e.{n}") for n in columns[kind]])
    pitching = rows.select("game_id", F.explode("pitching").alias("s")).select("game_id", "s.team", F.explode("s.pitcher").alias("p")).select("game_id", "team", "p.*")
    extra = {one: rows.select("game_id", F.explode(f"{box}.{one}").alias("e")).select("game_id", "e.*") for box, one in lists.items()}
    return {"game": game, "batting": own("batting"), "fielding": own("fielding"), "pitching": pitching, **extra}
