"""Readers, writers and nested encodings, including the encoding hazards of the dumps."""

import os
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from townpull.schema import PLACE_SCHEMA
from townpull.sources import files as FS

LINES = [
    # id name ascii alt lat lon fclass fcode cc cc2 a1 a2 a3 a4 pop elev dem tz date
    "1\t\"Quoted start\tQuoted start\t\t52.1\t21.0\tP\tPPL\tPL\t\t78\t001\t\t\t1200\t\t100\tEurope/Warsaw\t2024-01-06",
    "2\tEmb\"ed\tEmbed\ta,b\t50.0\t19.9\tP\tPPLA\tNA\t\t03\t0123\t\t\t999999999999\t\t-9999\tAfrica/Windhoek\tjunk",
    "3\tŁódź\tLodz\t\t\t\tP\tPPLC\tPL\t\t74\t\t\t\tjunk",
    "4\tShort\tShort\t\t51.0\t17.0\tA\tADM2",
]


@pytest.fixture()
def dump(tmp_out):
    p = os.path.join(tmp_out, "PL.txt")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("\n".join(LINES) + "\n")
    return p


def test_scan_places_hazards(spark, dump):
    rows = {r["geonameid"]: r for r in FS.scan_places(spark, dump).collect()}
    assert rows[1]["name"] == '"Quoted start' and rows[1]["admin2_code"] == "001"
    assert rows[1]["modification_date"].isoformat() == "2024-01-06"
    assert rows[2]["name"] == 'Emb"ed' and rows[2]["country_code"] == "NA"
    assert rows[2]["population"] is None  # > 2^31 -> null
    assert rows[2]["modification_date"] is None and rows[2]["dem"] == -9999
    assert rows[3]["name"] == "Łódź" and rows[3]["latitude"] is None and rows[3]["population"] is None
    assert rows[4]["feature_code"] == "ADM2" and rows[4]["population"] is None


def test_load_lenient_defaults_population(spark, dump):
    rows = {r["geonameid"]: r for r in FS.load_lenient(spark, dump).collect()}
    assert rows[3]["population"] == 0 and rows[2]["population"] == 0
    assert rows[1]["population"] == 1200
    nul = {r["geonameid"]: r for r in FS.load_lenient(spark, dump, null_population="null").collect()}
    assert nul[3]["population"] is None


def test_ingest_zipped_dumps(spark, dump, tmp_out):
    zdir = os.path.join(tmp_out, "zips")
    os.makedirs(zdir)
    with zipfile.ZipFile(os.path.join(zdir, "PL.zip"), "w") as zf:
        zf.write(dump, "PL.txt")
        zf.writestr("readme.md", "not a dump")
    rows = FS.ingest_zipped_dumps(spark, zdir, batch_rows=2).collect()
    assert sorted(r["geonameid"] for r in rows) == [1, 2, 3, 4]
    assert {r["geonameid"]: r["name"] for r in rows}[1] == '"Quoted start'


def test_csv_roundtrip_and_partitioned_output(spark, dump, tmp_out):
    df = FS.scan_places(spark, dump).filter(F.col("latitude").isNotNull())
    root = os.path.join(tmp_out, "processed")
    FS.write_csv_by_country(df, root)
    assert {"country_code=NA", "country_code=PL"} <= set(os.listdir(root))
    back = FS.read_partitioned_csv(spark, root, PLACE_SCHEMA)
    # a null (or empty) country lands in the default partition and reads back as null
    assert {r["country_code"] for r in back.collect()} == {"NA", "PL", None}
    # dynamic overwrite: rewriting one country keeps the other's folder
    FS.write_csv_by_country(df.filter(F.col("country_code") == "PL"), root)
    assert "country_code=NA" in os.listdir(root)
    got = {r["geonameid"]: r for r in FS.read_partitioned_csv(spark, root, PLACE_SCHEMA).collect()}
    assert got[2]["admin2_code"] == "0123" and got[1]["name"] == '"Quoted start'


def test_partitioned_csv_errors(spark, tmp_out):
    with pytest.raises(AnalysisException):
        FS.read_partitioned_csv(spark, os.path.join(tmp_out, "missing"), PLACE_SCHEMA)
    empty = os.path.join(tmp_out, "empty")
    os.makedirs(empty)
    with pytest.raises(ValueError):
        FS.read_partitioned_csv(spark, empty, PLACE_SCHEMA)


def test_merge_sorted(spark, dump):
    df = FS.scan_places(spark, dump)
    assert [r["geonameid"] for r in FS.merge_sorted(df).collect()] == [1, 2, 3, 4]
    with pytest.warns(UserWarning):
        FS.merge_sorted(df.drop("geonameid"))


def test_decode_nested_text(spark):
    df = spark.createDataFrame([
        ("""[{'metro_id': '1', 'metro_name': "L'Isle", 'force': 0.5, 'distance': 3.2}]""", "[[(52.1, 21.0), (52.2, 21.1), (52.1, 21.2)]]"),
        ("[]", "[]"), ("", ""), (None, None), ("junk", "junk"),
        ("[{'metro_id': None, 'metro_name': 'x', 'force': 1, 'distance': nan}, {'metro_id': 7.0, 'metro_name': 'None, n\\xe9e', "
         "'force': 0.5, 'distance': 2}]", "[[(1, 2), (3, 4), (5, 6)], [(7, 8), (9, 10), (1, 1)]]"),
    ], "c string, p string")
    out = df.select(FS.decode_candidates("c").alias("c"), FS.decode_polygons("p").alias("p")).collect()
    assert out[0]["c"][0]["metro_id"] == 1 and out[0]["c"][0]["metro_name"] == "L'Isle"
    assert out[0]["p"][0][1]["lat"] == 52.2 and out[0]["p"][0][1]["lon"] == 21.1
    for r in out[1:5]:
        assert r["c"] == [] and r["p"] == []
    # None and nan null their field only; escapes and quoted text stay
    assert [tuple(x) for x in out[5]["c"]] == [(None, "x", 1.0, None), (7, "None, née", 0.5, 2.0)]
    assert len(out[5]["p"]) == 2
    # encoded JSON decodes back to the same values
    enc = FS.encode_nested(df.select(FS.decode_polygons("p").alias("polygons")), ["polygons"])
    back = enc.select(FS.decode_polygons("polygons").alias("p")).collect()
    assert back[0]["p"] == out[0]["p"] and back[1]["p"] == []


def test_write_merged_single_file_and_zip_packing(spark, dump, tmp_out):
    df = FS.scan_places(spark, dump)
    out = os.path.join(tmp_out, "merged")
    FS.write_merged(df, out, single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    back = spark.read.option("header", True).csv(out).collect()
    assert [int(r["geonameid"]) for r in back] == [1, 2, 3, 4]
    text, zips = os.path.join(tmp_out, "text"), os.path.join(tmp_out, "zips")
    FS.write_dump(df.repartition(2), text)
    archives = FS.zip_text_parts(spark, text, zips).collect()
    assert len(archives) == len([f for f in os.listdir(text) if f.startswith("part-")])
    again = FS.ingest_zipped_dumps(spark, zips)
    assert sorted(r["geonameid"] for r in again.collect()) == [1, 2, 3, 4]


def test_lenient_numbers(spark, tmp_out):
    line = "{}\tn\ta\t\t50.0\t{}\tP\tPPL\tPL\t\t\t\t\t\t{}\t\t\t\t"
    rows = [("1", "20.0", "1500.0"), ("2.0", "nan", "1e5"), ("x", "inf", "nan"), ("4", "-1e1", "9e99"), ("5", "", "")]
    path = os.path.join(tmp_out, "dump.txt")
    with open(path, "w") as f:
        f.write("\n".join(line.format(*r) for r in rows) + "\n")
    got = [(r["geonameid"], r["longitude"], r["population"]) for r in FS.load_lenient(spark, path).collect()]
    assert got == [(1, 20.0, 1500), (2, None, 100000), (None, None, 0), (4, -10.0, 0), (5, None, 0)]


def test_archives_are_inflated_by_many_tasks(spark, tmp_out):
    import zipfile
    folder = os.path.join(tmp_out, "zips")
    os.makedirs(folder)
    row = "{}\tn\ta\t\t50.0\t20.0\tP\tPPL\tPL\t\t\t\t\t\t1\t\t\t\t\n"
    for i in range(24):
        with zipfile.ZipFile(os.path.join(folder, f"c{i}.zip"), "w") as z:
            z.writestr(f"c{i}.txt", "".join(row.format(i * 50 + j) for j in range(50)))
            z.writestr("readme.md", "not a dump")
    lines, n, _ = FS.inflate_archives(spark, folder)
    used = lines.select(F.spark_partition_id().alias("p")).distinct().count()
    assert n == 24 and used >= 12
    assert FS.ingest_zipped_dumps(spark, folder).count() == 1200
    big = os.path.join(tmp_out, "one")
    os.makedirs(big)
    with zipfile.ZipFile(os.path.join(big, "world.zip"), "w") as z:
        z.writestr("world.txt", "".join(row.format(j) for j in range(20000)))
    rows = FS.ingest_zipped_dumps(spark, big, split_bytes=64 << 10)
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() >= 8
    assert rows.agg(F.countDistinct("geonameid")).first()[0] == 20000


def test_country_writer_evaluates_once(spark, tmp_out, dump):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = FS.scan_places(spark, dump)
    n = df.count()
    FS.write_csv_by_country(df.mapInPandas(count, df.schema), os.path.join(tmp_out, "once"), rows_per_task=1)
    assert seen.value == n


def test_saved_candidates_under_either_name(spark):
    for name in ("candidates", "candidate_metro_ids"):
        df = spark.createDataFrame([("[{'metro_id': 3, 'metro_name': 'a', 'force': 0.5, 'distance': 1.0}]", "[]")],
                                   f"{name} string, polygons string")
        r = FS.decode_nested(df).first()
        assert r["candidates"][0]["metro_id"] == 3 and r["polygons"] == []


def test_members_of_an_archive_are_tasks_of_their_own(spark, tmp_out):
    """Stored, deflated and empty members, ends of lines across blocks, other members left out."""
    import zipfile

    from townpull.sources import archives as AR
    folder = os.path.join(tmp_out, "zips")
    os.makedirs(folder)
    texts = {f"m{i}.txt": "".join(f"{i}-{j} żółć " + "x" * (j % 700) + ("\r\n" if j % 3 else "\n") for j in range(4000)) for i in range(5)}
    texts |= {"empty.txt": "", "last.txt": "no end of line", "blank.txt": "\n\n"}
    with zipfile.ZipFile(os.path.join(folder, "all.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in texts.items():
            z.writestr(name, text, zipfile.ZIP_STORED if name == "m0.txt" else zipfile.ZIP_DEFLATED)
        z.writestr("readme.md", "not a dump")
    lines, n, _ = FS.inflate_archives(spark, folder, batch_rows=100)
    assert n == 1 and lines.select(F.spark_partition_id()).distinct().count() >= 5
    want = sorted(x for t in texts.values() for x in t.replace("\r\n", "\n").split("\n")[:len(t.splitlines())])
    assert sorted(r["value"] for r in lines.collect()) == want
    whole = FS.inflate_archives(spark, folder, by_range=False)[0]
    assert sorted(r["value"] for r in whole.collect()) == want
    # pieces are bounded, whatever the member's size
    member = next(m for m in AR.members("file://" + os.path.join(folder, "all.zip"), ".txt") if m.name == "m3.txt")
    assert b"".join(AR.inflated(member)).decode() == texts["m3.txt"]


def test_an_archive_of_zeros_is_inflated_in_pieces(spark, tmp_out):
    import zipfile

    from townpull.sources import archives as AR
    path = os.path.join(tmp_out, "zeros.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        with z.open("zeros.txt", "w") as f:
            for _ in range(64):
                f.write(b"\0" * (1 << 20))
    (member,) = AR.members("file://" + path, ".txt")
    assert member.packed < 100_000
    sizes = [len(p) for p in AR.inflated(member)]
    assert sum(sizes) == 64 << 20 and max(sizes) <= AR.INFLATED


def test_damaged_and_foreign_archives(spark, tmp_out):
    import zipfile

    from townpull.sources import archives as AR
    folder = os.path.join(tmp_out, "bad")
    os.makedirs(folder)
    path = os.path.join(folder, "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.txt", "one\ntwo\n")
    with open(path, "r+b") as f:
        data = f.read().replace(b"two", b"tvo", 1)
        f.seek(0)
        f.write(data)
    with pytest.raises(Exception, match="damaged"):
        FS.inflate_archives(spark, folder)[0].collect()
    assert AR.readable_here("file:/tmp/x") and not AR.readable_here("viewfs://store/in/a.zip")
    none = os.path.join(tmp_out, "none")
    os.makedirs(none)
    assert FS.ingest_zipped_dumps(spark, none).count() == 0


def test_counts_are_observed_on_the_write(spark, tmp_out):
    """The counts are those of a separate aggregate, and cost no job of their own."""
    from townpull.operators.profile import stage_counts
    from townpull.plans.assign import assign_metros, write_assigned
    from townpull.sources.fixture import places
    pl = places(spark, "/root/testdata/sf0.001")
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext

    def jobs(name, fn):
        sc.setJobGroup(name, name)
        out = fn()
        sc.setJobGroup("", "")
        return out, len(tracker.getJobIdsForGroup(name))

    for rule, kw in (("share_only", {}), ("share_excl_ppl", {}), ("share_only", {"chunk_size": 1})):
        path = os.path.join(tmp_out, f"{rule}{len(kw)}")
        counts, n = jobs(f"counted-{path}", lambda: write_assigned(pl, path, rule=rule, **kw))
        _, plain = jobs(f"plain-{path}", lambda: assign_metros(pl, rule=rule, **kw).write.mode("overwrite").parquet(path + "-plain"))
        assert counts == stage_counts(pl, assign_metros(pl, rule=rule)).first().asDict()
        assert n <= plain
        assert spark.read.parquet(path).exceptAll(spark.read.parquet(path + "-plain")).count() == 0


def test_only_texts_that_may_be_odd_meet_the_pattern(spark):
    """The pattern that tells Python literals from JSON takes longer than reading the JSON; it is kept from plain texts."""
    from townpull.sources.files import decode_candidates
    entry = '[{"metro_id": 1, "metro_name": "%s", "force": 0.5, "distance": 2.0}]'
    names = ["Plain", "Banana", "None", "an inf", "a \\\\ b"]
    df = spark.createDataFrame([(i, entry % n) for i, n in enumerate(names)] + [(9, None), (10, "")], "i int, t string")
    out = df.select("i", decode_candidates("t").alias("c"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Contains(") < plan.index("RLIKE"), plan
    got = {r["i"]: [x["metro_name"] for x in r["c"]] for r in out.collect()}
    assert got == {**{i: [n.replace("\\\\", "\\")] for i, n in enumerate(names)}, 9: [], 10: []}
