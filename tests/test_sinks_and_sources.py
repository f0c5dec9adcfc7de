import gzip
import hashlib
import zipfile

import pytest

from pennant.functions import clean
from pennant.plans.registry import QUERIES
from pennant.sources import readers, sinks


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def test_names():
    assert sinks.clean_names(["Player ID", "2B", "ok_1"]) == ["player_id", "n2b", "ok_1"]
    for bad in (["a", "A"], ["", "b"]):
        with pytest.raises(ValueError):
            sinks.clean_names(bad)


def test_scoped_replace_clears_empty_scopes(spark):
    old = spark.createDataFrame([("2023", 1), ("2024", 2), ("2025", 3)], "season string, v int")
    new = spark.createDataFrame([("2024", 9)], "season string, v int")
    assert rows(sinks.scoped_replace(old, new, "season")) == [("2023", 1), ("2024", 9), ("2025", 3)]
    assert rows(sinks.scoped_replace(old, new, "season", ["2024", "2025"])) == [("2023", 1), ("2024", 9)]


def test_identity_insert_and_upsert(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        sinks.check_identity(df, ["k"])
    old = spark.createDataFrame([(1, "x", 1, None), (2, "y", 1, "q")], "k int, v string, n int, w string")
    new = spark.createDataFrame([(2, "z", 2, None), (3, "u", 5, "r"), (3, "u", 5, "s")], "k int, v string, n int, w string")
    assert rows(sinks.insert_absent(old, new, ["k"]), "k", "v", "w") == [(1, "x", None), (2, "y", "q"), (3, "u", "r")]
    got = sinks.upsert(old, new.filter("w is null or w = 'r'"), ["k"], {"v": "keep", "n": "add", "w": "fill"})
    assert rows(got, "k", "v", "n", "w") == [(1, "x", 1, None), (2, "y", 3, "q"), (3, "u", 5, "r")]
    filled = sinks.fill_missing(old, spark.createDataFrame([(1, "f"), (2, "g")], "k int, w string"), ["k"], ["w"])
    assert rows(filled, "k", "w") == [(1, "f"), (2, "q")]


def test_versions_and_content_id(spark, tmp_path):
    a = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    path = str(tmp_path / "t")
    sinks.write_version(a, path)
    sinks.write_version(sinks.read_version(spark, path).filter("k = 1"), path)
    assert rows(sinks.read_version(spark, path)) == [(1, "a")]
    assert sinks.content_id(a) == sinks.content_id(a.orderBy("v")) != sinks.content_id(a.filter("k = 1"))


def test_dirty_values(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("12000.0",), ("6500?",), ("<1000",), ("-1.0",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(clean.guarded_int(F.col("x"))).collect()] == [12000, None, None, None, None, None]
    one = spark.createDataFrame([("6.2", "a-b-2024-04-05", "KXMLBGAME-24APR05NYY", "['x', 'y']", "0.0000", "0.4", "0.6", "-", r"Pe\xc3\xb1a")], "ip string, slug string, tick string, list string, last string, bid string, ask string, gb string, name string")
    r = one.select(
        clean.outs_pitched(F.col("ip")).alias("outs"), clean.slug_date(F.col("slug")).cast("string").alias("d"), clean.ticker_date(F.col("tick"), "KXMLBGAME").cast("string").alias("t"), clean.literal_list(F.col("list")).alias("l"),
        clean.mid_price(F.col("last"), F.col("bid"), F.col("ask")).alias("mid"), clean.games_back(F.col("gb")).alias("gb"), clean.repair_escapes(F.col("name")).alias("name"),
        clean.base_state(F.lit("r1"), F.lit(""), F.lit("r3")).alias("bases"),
    ).first()
    assert (r.outs, r.d, r.t, r.l, r.gb, r.name, r.bases) == (20, "2024-04-05", "2024-04-05", ["x", "y"], 0.0, "Peña", "1_3") and r.mid == pytest.approx(0.5)


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/2024.csv", "ID,Name\n1,Ann\n2,\n")
        z.writestr("readme.txt", "no")
    got = readers.zip_members(spark, str(tmp_path / "a.zip"), ["id", "name"])
    assert rows(got, "id", "name", "_member") == [("1", "Ann", "x/2024.csv"), ("2", "", "x/2024.csv")]
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("../evil.csv", "ID\n1\n")
    with pytest.raises(Exception, match="leaves the archive"):
        readers.zip_members(spark, str(tmp_path / "b.zip"), ["id"]).collect()


def test_json_documents(spark):
    doc = '{"innings":[{"num":1,"home":{"runs":0,"hits":1,"errors":0},"away":{"runs":2}}]}'
    df = spark.createDataFrame([(7, doc)], "game int, doc string")
    assert rows(readers.line_scores(df, "doc", ["game"])) == [(7, 1, "away", 2, None, None), (7, 1, "home", 0, 1, 0)]
    players = '{"teams":{"ID1":{"fullName":"A","gamesPlayed":3},"ID2":{"fullName":"B"}}}'
    df = spark.createDataFrame([(7, players)], "game int, doc string")
    got = readers.flatten_map(df, "doc", "struct<teams:map<string,struct<fullName:string,gamesPlayed:int>>>", "teams", ["game"])
    assert got.columns == ["game", "key", "full_name", "games_played"] and rows(got) == [(7, "ID1", "A", 3), (7, "ID2", "B", None)]
    df = spark.createDataFrame([(1, '["Yes","No"]', '["0.4"]')], "id int, names string, prices string")
    assert rows(readers.outcomes(df, ["id"], outcome="names", price="prices")) == [(1, 0, "Yes", "0.4"), (1, 1, "No", None)]
    assert rows(readers.time_chunks(spark, "2024-02-01", "2024-02-10", 7)) and readers.time_chunks(spark, "2024-02-01", "2024-02-10", 7).count() == 2


def test_feeds_and_event_files(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><guid>g1</guid><title>A</title><link>u</link></item><item><title>B</title><link>v</link></item><item><title>C</title></item></channel></rss>")
    assert rows(readers.feed_items(spark, str(tmp_path / "f.xml")), "key", "title") == sorted([("g1", "A"), (hashlib.sha256(b"v").hexdigest(), "B")], key=repr)
    (tmp_path / "e.EVA").write_text('id,G1\nversion,2\ninfo,date,2024/04/01\nstart,p1,"A B",0,1,9\nplay,1,0,p1,00,X,S8\nplay,1,0,p2,12,CSS,K\nid,G2\nplay,1,1,p9,00,,NP\n')
    plays = readers.plays_of(readers.event_records(spark, str(tmp_path / "*.EVA")))
    assert rows(plays, "game_id", "play", "event") == [("G1", 1, "S8"), ("G1", 2, "K"), ("G2", 1, "NP")]


def test_event_files_are_read_in_parts(spark, tmp_path):
    """No row holds a file, whatever its splits; texts before the first id, other line ends, quoted ids and a game in two places included."""
    text = "com,before\nid,G1\nplay,1,0,a,00,X,S8\n\nplay,1,0,b,00,X,K\nid,G2\r\nplay,1,1,c,00,X,W\r\n\"id\",G3\nplay,1,0,d,00,X,W\nid,G1\nplay,2,0,e,00,X,HR\n"
    more = "".join(f"id,H{k}\nversion,2\n" + "".join(f"play,1,0,p{k}-{j},00,X,K\n" for j in range(k % 7)) for k in range(40))
    (tmp_path / "a.EVA").write_text(text + more, newline="")
    (tmp_path / "b.EVA").write_text("id,B1\nplay,1,0,z,00,X,S8", newline="")
    want = [("G1", 1, "a"), ("G1", 2, "b"), ("G1", 3, "e"), ("G2", 1, "c"), ("G3", 1, "d"), ("B1", 1, "z")] + [(f"H{k}", j + 1, f"p{k}-{j}") for k in range(40) for j in range(k % 7)]
    name, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "97", "31", "7"):
            spark.conf.set(name, size)
            records = readers.event_records(spark, str(tmp_path))
            assert rows(readers.plays_of(records), "game_id", "play", "batter") == sorted(want, key=repr), size
            assert rows(records.filter("game_id IS NULL"), "kind", "c1") == [("com", "before")]
            assert size != "128m" or [r.line for r in records.filter("_file LIKE '%a.EVA'").orderBy("line").limit(5).collect()] == [0, 1, 2, 4, 5]
    finally:
        spark.conf.set(name, before)


def test_verified_artifacts(spark, tmp_path):
    path = tmp_path / "a.ndjson.gz"
    path.write_bytes(gzip.compress(b'{"k":1}\n{"k":2}\n'))
    digest = hashlib.sha256(path.read_bytes()).hexdigest()
    assert readers.verified_ndjson(spark, str(path), {"a.ndjson.gz": digest}, "k int").count() == 2
    with pytest.raises(ValueError):
        readers.verified_ndjson(spark, str(path), {"a.ndjson.gz": "0"}, "k int")


def test_changed_artifact_is_refused(spark, tmp_path):
    path = str(tmp_path / "artifact")
    digests = {r["name"]: r["digest"] for r in sinks.write_artifact(spark.range(3), path).collect()}
    assert sorted(r.id for r in readers.verified_ndjson(spark, f"{path}/*.json.gz", digests, "id long").collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="differ"):
        readers.verified_ndjson(spark, f"{path}/*.json.gz", {n: "0" for n in digests}, "id long")


def test_scopes_of_all_tables(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,), (None,)], "s int"), spark.createDataFrame([(2,), (3,), (None,)], "s int")
    assert [r.s for r in readers.complete_scopes({"a": a, "b": b}, "s").collect()] == [2]
    assert readers.complete_scopes({"a": a, "b": b.limit(0)}, "s").count() == 0


def test_ledger_keeps_other_scopes(spark):
    ledger = spark.createDataFrame([("x", 1, 9), ("x", 2, 9)], "dataset string, scope int, n long")
    batch = spark.createDataFrame([("x", 2), ("x", 2), ("y", 1)], "dataset string, scope int")
    assert sorted(map(tuple, sinks.record_loads(ledger, batch, ["dataset", "scope"]).collect())) == [("x", 1, 9), ("x", 2, 2), ("y", 1, 1)]


def test_bad_lines_are_set_apart(spark, tmp_path):
    """The verdict on a line is the same whatever columns are read afterwards."""
    (tmp_path / "a.csv").write_text("id,price\n1,2\nx,3\n4,n/a\n5,\n6,7,8\n")
    from pyspark.sql.types import StructType

    good, bad = readers.csv_or_quarantine(spark, str(tmp_path / "a.csv"), StructType.fromDDL("id long, price long"))
    assert rows(good) == [(1, 2), (5, None)] and rows(good, "id") == [(1,), (5,)] and good.count() == 2
    assert rows(bad, "_corrupt_record") == [("4,n/a",), ("6,7,8",), ("x,3",)] and bad.count() == 3
    assert all(r[0].endswith("a.csv") for r in bad.select("_file").collect())


def test_box_tables(spark):
    """Elements without a root, bare ampersands, several fielding blocks, absent parts."""
    box = (
        '<boxscore game_id="A1" date="1900/04/19"><linescore away_runs="3"/><players team="X"><player id="p1" lname="Smith & Co" slot="1" pos="8"><batting ab="4" h="1"/><fielding pos="8" po="2"/><fielding pos="7" po="0"/></player>'
        '<player id="p2"/></players><pitching team="X"><pitcher id="p9" so="2"/></pitching><homeruns><homerun players="p1"/><homerun players="p2"/></homeruns></boxscore>\n<boxscore game_id="B2"></boxscore>'
    )
    columns = {"game": ("game_id", "date"), "linescore": ("away_runs",), "batting": ("ab", "h"), "fielding": ("pos", "po"), "pitching": ("id", "so"), **{one: ("players",) for one in readers.BOX_LISTS.values()}}
    tables = readers.box_tables(spark.createDataFrame([(box,), (None,), ("no box",)], "x string"), "x", columns)
    got = {n: sorted((tuple(r) for r in df.collect()), key=repr) for n, df in tables.items()}
    assert got["game"] == [("A1", "1900/04/19", "3"), ("B2", None, None)]
    assert got["batting"] == [("A1", "X", "p1", "Smith & Co", None, "1", None, "8", "4", "1")]
    assert [r[-2:] for r in got["fielding"]] == [("7", "0"), ("8", "2")] and got["pitching"] == [("A1", "X", "p9", "2")]
    assert got["homerun"] == [("A1", "p1"), ("A1", "p2")] and got["double"] == got["sacbunt"] == [] and len(tables) == 11


def test_box_scores_are_parsed_once(spark, sf):
    """All tables of the box scores read rows that are parsed already."""
    plan = QUERIES["src_box_score"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_xml" not in plan and "XmlToStructs" not in plan


def test_two_writers_take_two_versions(spark, tmp_path, monkeypatch):
    """A writer that another one overtakes writes a version of its own."""
    path, inner = str(tmp_path / "t"), []
    create = sinks.Files.create

    def overtaken(self, name, value):
        if not inner:
            inner.append(1)
            sinks.write_version(spark.createDataFrame([("other",)], "v string"), path)
        return create(self, name, value)

    monkeypatch.setattr(sinks.Files, "create", overtaken)
    assert sinks.write_version(spark.createDataFrame([("one",)], "v string"), path).endswith("/v2")
    assert {spark.read.parquet(f"{path}/v{n}").first().v for n in (1, 2)} == {"one", "other"} and sinks.read_version(spark, path).first().v == "one"
