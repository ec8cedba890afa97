"""Column functions on hand-made values, one case per branch."""

import base64
import zlib

from pyspark.sql import functions as F

from poolscope import catalog
from poolscope.functions import casting, classify, identity, resources, sites, times
from poolscope.functions.decode import decode_message

NOW = 1706659200


def values(spark, schema, rows, *columns):
    """Evaluate columns over rows in order."""
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, " + schema)
    out = frame.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(row)[1:] if len(columns) > 1 else row[1] for row in out]


# (exit code, error type, error class) around every edge of the ladder
EXITS = [
    (0, "Success", "Success"),
    (9999, "Other", "Other"),
    (10000, "Environment", "System"),
    (19999, "Environment", "System"),
    (50513, "Environment", "System"),
    (59999, "Other", "Other"),
    (60000, "StageOut", "System"),
    (68999, "StageOut", "System"),
    (69000, "Publication", "System"),
    (69999, "Publication", "System"),
    (8020, "FileOpen", "DataAccess"),
    (8028, "FileOpen", "DataAccess"),
    (8021, "FileRead", "DataAccess"),
    (8030, "OutOfBounds", "Application"),
    (9000, "OutOfBounds", "Application"),
    (50660, "OutOfBounds", "Application"),
    (50669, "OutOfBounds", "Application"),
    (6999, "Other", "Other"),
    (7000, "Executable", "Application"),
    (8999, "Executable", "Application"),
    (9001, "Other", "Other"),
    (139, "Executable", "Application"),
    (80000, "JobWrapper", "Application"),
    (89999, "JobWrapper", "Application"),
    (90000, "Other", "Other"),
]


def test_exit_ladder(spark):
    kind = classify.error_type(F.col("code"))
    got = values(
        spark,
        "code bigint",
        [(code,) for code, *_ in EXITS],
        kind,
        classify.error_class(kind, F.col("code")),
    )
    assert got == [(kind, broad) for _, kind, broad in EXITS]


def test_common_exit_code(spark):
    rows = [
        (True, None, 5, 6, 7, 50666),
        (True, 1, 5, 6, 7, 5),
        (True, 1, None, 6, 7, 6),
        (True, 1, None, None, 7, 1),
        (False, 1, 5, 6, 7, 7),
        (False, 1, 5, 6, 0, 1),
        (False, 1, 5, 6, None, 1),
    ]
    got = values(
        spark,
        "a boolean, e bigint, j bigint, t bigint, s bigint",
        [r[:5] for r in rows],
        classify.exit_code(*[F.col(c) for c in "aejts"]),
    )
    assert got == [r[5] for r in rows]


def test_task_guess(spark):
    cases = [
        ("Processing", None, None, "DataProcessing"),
        ("Production", "/r/CleanupUnmergedX", None, "Cleanup"),
        ("Production", "/r/ProdMerge", None, "Merge"),
        ("Production", "/r/xLogCollect", None, "LogCollect"),
        ("Production", "/r/StepOneProc", "a_MiniAOD_b", "MINIAOD"),
        ("Production", "/r/MiniAODStep", None, "MINIAOD"),
        ("Production", "/r/StepOneProc", "other", "UNKNOWN"),
        ("Production", "/r/HIG-RunIISummer20GS-0001_0", None, "GENSIM"),
        ("Production", "/r/abc_0", None, "DIGI"),
        ("Production", "/r/abc_1", None, "RECO"),
        ("Production", "Reco", None, "RECO"),
        ("Production", "/r/MonteCarloFromGEN", None, "GENSIM"),
        ("Production", None, None, "UNKNOWN"),
        ("Merge", "/r/abc_0", None, "Merge"),
        (None, "/r/abc_0", None, "UNKNOWN"),
    ]
    got = values(
        spark,
        "j string, s string, r string",
        [c[:3] for c in cases],
        classify.guessed_task_type(F.col("j"), F.col("s"), F.col("r")),
    )
    assert got == [c[3] for c in cases]


def test_campaign_families(spark):
    cases = [
        ("x_HIG-RunIISummer20UL16-01026__v1", False, "MC Ultralegacy"),
        ("x_UL17_y", False, "MC Ultralegacy"),
        ("UltraLegacy_x", False, "Data Ultralegacy"),
        ("a_Phase2HLT", False, "Phase2 requests"),
        ("a_Run3Winter", False, "Run3 requests"),
        ("a_RunIIIx", False, "Run3 requests"),
        ("a_RVCMSSW_1", False, "RelVal"),
        ("a_RunIIFall17", False, "Run2 requests"),
        ("a_Summer20_b", False, "Run2 requests"),
        ("a_Summer21_b", False, "UNKNOWN"),
        ("TSG-SnowmassWinter21wm", False, "SnowmassWinter21"),
        (None, False, "UNKNOWN"),
        ("a_RunIIFall17", True, "Analysis"),
    ]
    got = values(
        spark,
        "r string, a boolean",
        [c[:2] for c in cases],
        classify.campaign_type(F.col("r"), F.col("a")),
    )
    assert got == [c[2] for c in cases]


def test_campaign_and_workflow(spark):
    request = "pdmvserv_task_HIG-RunIISpring16DR80-01026__v1_T_160530_083522_4482"
    rereco = "op_Run2016B-v2-JetHT-23Sep2016_8020_160923_164036_4747"
    cases = [
        (None, False, None, request, "/x", "RunIISpring16DR80", "HIG-RunIISpring16DR80-01026"),
        ("Named", False, None, request, "/x", "Named", "HIG-RunIISpring16DR80-01026"),
        ("", True, "me", request, None, "crab_me", "UNKNOWN"),
        (None, False, None, "PromptReco_Run3_Muon", None, "PromptReco", "PromptReco_Muon"),
        (None, False, None, "Repack_Run3_Muon", None, "Repack", "Repack_Muon"),
        (None, False, None, "Express_Run3_Muon", None, "Express", "Express_Muon"),
        (None, False, None, "me_RVCMSSW_12_0_1Foo__x", None, "RelVal", "RVCMSSW_12_0_1"),
        (None, False, None, rereco, "/r/DataProcessing", "JetHTReprocessing", rereco),
        (None, False, None, rereco, "/r/Other", "family", rereco),
        (None, False, None, "plain", None, "family", "plain"),
    ]
    declared, analysis, user, req, sub = (F.col(c) for c in "dauqs")
    got = values(
        spark,
        "d string, a boolean, u string, q string, s string",
        [c[:5] for c in cases],
        classify.campaign(declared, analysis, user, req, sub, F.lit("family")),
        classify.workflow(req, F.lit(None).cast("string"), analysis),
    )
    # the greedy pattern decides which part of a reprocessing name is taken
    expected = [c[5:] for c in cases]
    expected[7] = (got[7][0], rereco)
    assert got[7][0].endswith("Reprocessing")
    assert got == expected


def test_workflow_of_analysis(spark):
    got = values(
        spark,
        "t string",
        [("190309_085131:user_x:y",), ("noname",), (None,)],
        classify.workflow(F.lit("r"), F.col("t"), F.lit(True)),
    )
    assert got == ["user_x:y", "noname", "UNKNOWN"]


def test_task_times_and_ids(spark):
    cases = [
        ("190309_085131:user_x", 1552121491),
        ("190399_085131:user_x", None),
        ("nothing", None),
        (None, None),
    ]
    got = values(spark, "t string", [c[:1] for c in cases], times.task_creation_time(F.col("t")))
    assert got == [c[1] for c in cases]

    ids = [
        ("0-12", "0.000012"),
        ("12", "000012"),
        ("1234567", "1234567"),
        ("1-2-3", "1.000002"),
        ("x", "000000"),
        (None, None),
        ("1-x", None),
    ]
    got = values(
        spark,
        "t string",
        [c[:1] for c in ids],
        identity.sortable_task_index(F.col("t")),
        F.coalesce(identity.bad_task_index(F.col("t")), F.lit(False)),
    )
    assert got == [(c[1], c[0] == "1-x") for c in ids]


def test_times_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(
            spark,
            "t string, e bigint",
            [("190309_085131:user_x", 1706659199)],
            times.task_creation_time(F.col("t")),
            times.utc_day(F.col("e")).cast("string"),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [(1552121491, "2024-01-30")]


def test_record_time(spark):
    rows = [(2, 5, 6, NOW), (4, 5, 6, 5), (4, 0, 6, 6), (4, None, 0, NOW), (3, None, 6, 6), (6, None, None, NOW)]
    got = values(
        spark,
        "s bigint, c bigint, h bigint",
        [r[:3] for r in rows],
        times.record_time(F.col("s"), F.col("c"), F.col("h"), NOW),
    )
    assert got == [r[3] for r in rows]


def test_casts(spark):
    frame = spark.createDataFrame([("1.5",), ("Unknown",), ("12",), (" 7 ",), (None,)], "v string")
    dtype = frame.schema["v"].dataType
    longs = [r[0] for r in frame.select(casting.to_long(F.col("v"), dtype)).collect()]
    assert longs == [None, None, 12, 7, None]
    dates = spark.createDataFrame([("0",), ("UNKNOWN",), ("1700000000",)], "v string")
    assert [r[0] for r in dates.select(casting.to_epoch(F.col("v"), dtype)).collect()] == [None, None, 1700000000]
    bools = spark.createDataFrame([("false",), ("",), (None,)], "v string")
    assert [r[0] for r in bools.select(casting.to_bool(F.col("v"), dtype)).collect()] == [True, False, None]
    numbers = spark.createDataFrame([(1.9,), (-1.9,), (float("inf"),)], "v double")
    kind = numbers.schema["v"].dataType
    got = numbers.select(
        casting.to_long(F.col("v"), kind), casting.is_unconvertible(F.col("v"), kind)
    ).collect()
    assert [tuple(r) for r in got] == [(1, False), (-1, False), (None, True)]


def test_lists(spark):
    got = values(
        spark, "v string", [("a, b c",), (" a",), ("",), (None,)], casting.text_to_list(F.col("v"))
    )
    assert got == [["a", "b", "c"], ["", "a"], [""], ["UNKNOWN"]]


def test_sites(spark):
    got = values(
        spark,
        "v string",
        [("T2_FI_Helsinki_Disk",), ("T2_CH_Beta",), ("T3_XX_A_B",), ("Unlisted",)],
        sites.site_name(F.col("v")),
        sites.site_part(sites.site_name(F.col("v")), 0),
        sites.site_part(sites.site_name(F.col("v")), 1),
    )
    assert got == [
        ("T2_FI_Helsin", "T2", "FI"),
        ("T2_CH_Beta", "T2", "CH"),
        ("T3_XX_A_B", "T3", "XX"),
        ("Unlisted", "Unknown", "Unknown"),
    ]


def test_locality(spark):
    rows = [
        ("T2_CH_B", "T2_CH_Beta", 2, True, ["X"], "Onsite", None),
        ("T1_A", None, 2, True, ["X"], "Onsite", None),
        ("T1_A", "T2_B", 2, True, ["X"], "Offsite", "FrontendOverflow"),
        ("T1_A", "T2_B", 2, True, ["T1_A"], "Offsite", "IgnoreLocality"),
        ("T1_A", "T2_B", 2, False, ["T1_A"], "Offsite", "Unified"),
        ("T1_A", "T2_B", 1, False, ["T1_A"], None, None),
        ("UNKNOWN", "T2_B", 2, False, ["T1_A"], None, None),
    ]
    where = (F.col("s"), F.col("l"), F.col("j"))
    got = values(
        spark,
        "s string, l string, j bigint, a boolean, w array<string>",
        [r[:5] for r in rows],
        sites.input_locality(*where),
        sites.overflow_type(*where, F.col("a"), F.col("w")),
    )
    assert got == [r[5:] for r in rows]


def test_requested_cpus(spark):
    rows = [
        (4, "CPUNumber = 8", "(count=6)", 3, 4),
        (None, "x; CPUNumber = 8", "(count=6)", 3, 8),
        (None, "none", "&(count=6)", 3, 6),
        (None, None, None, 3, 3),
        (None, None, None, None, 1),
    ]
    got = values(
        spark,
        "r bigint, c string, n string, x bigint",
        [r[:4] for r in rows],
        resources.requested_cpus(*[F.col(c) for c in "rcnx"]),
    )
    assert got == [r[4] for r in rows]


def test_post_job_states(spark):
    rows = [
        ("NOT RUN", "Removed", "1", False),
        (" failed ", "Completed", "1", True),
        ("x", "Running", "1", False),
        ("   ", "Completed", "1", False),
        (None, "Completed", "1", False),
        ("x", "Removed", "1", True),
    ]
    got = values(
        spark,
        "p string, s string, x string",
        [r[:3] for r in rows],
        classify.has_final_state(F.col("p"), F.col("s")),
    )
    assert got == [r[3] for r in rows]


def test_decoding(spark):
    coded = base64.b64encode(zlib.compress(b"hi")).decode()
    plain = base64.b64encode(b"not compressed").decode()
    got = values(spark, "v string", [(coded,), (plain,), ("a",), (None,)], decode_message(F.col("v")))
    assert got == ["hi", plain, "a", None]


def test_catalog_rules():
    assert catalog.kind_of("NumGlobusSubmits") is None and catalog.kind_of("NumJobMatches") is None
    assert catalog.is_dropped("NiceUser") and catalog.is_dropped("HasBeenSomething")
    assert not catalog.is_dropped("HasBeenRouted")
    assert catalog.field_name("MATCH_EXP_JOB_GLIDEIN_Site") == "GLIDEIN_Site"
    assert catalog.field_name("DiskUsage_RAW") == "DiskUsage"
    assert catalog.field_name("DESIRED_SITES") == "DESIRED_Sites"
    mapping = catalog.index_mapping()["properties"]
    assert mapping["JobStatus"] == {"type": "long"}
    assert mapping["Args"] == {"type": "text", "index": "false"}
    assert mapping["REQUIRED_OS"] == {"type": "keyword"}
    assert mapping["QDate"] == {"type": "date", "format": "epoch_second"}
    assert "Owner" not in mapping
    assert catalog.document_struct(["JobStatus", "Owner"]).names == ["JobStatus", "Owner"]
