"""Keys, days and files in a given zone do not depend on the session's zone."""

import pytest
from pyspark.sql import functions as F

from assetlens import functions as fn
from assetlens.session import checkpoint_dir, is_local
from assetlens.sinks import write_day_files

# epoch seconds -> (hour, ISO weekday, month, day) in Asia/Shanghai; two of them in hours that New York skips or repeats
INSTANTS = {
    1704067200: (8, 1, 1, "2024-01-01"),    # 2024-01-01T00:00Z
    1704099600: (17, 1, 1, "2024-01-01"),   # 09:00Z
    1704128400: (1, 2, 1, "2024-01-02"),    # 17:00Z
    1710054000: (15, 7, 3, "2024-03-10"),   # 2024-03-10T07:00Z
    1730613600: (14, 7, 11, "2024-11-03"),  # 2024-11-03T06:00Z
    1730617200: (15, 7, 11, "2024-11-03"),
}


@pytest.fixture(params=["UTC", "Asia/Shanghai", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_keys_and_day_files(spark, zone, tmp_dir):
    df = spark.createDataFrame([(s,) for s in INSTANTS], "s long").withColumn("event_time", F.timestamp_seconds("s"))
    got = {r[0]: tuple(r)[1:] for r in df.select("s", *fn.segment_candidates("event_time", "Asia/Shanghai"),
                                                 fn.local_day("event_time", "Asia/Shanghai")).collect()}
    assert got == INSTANTS
    keys = {r[0]: tuple(r)[1:] for r in df.select("s", *[fn.segment_key("event_time", i, "Asia/Shanghai") for i in (1, 2, 3)]).collect()}
    assert keys == {s: v[:3] for s, v in INSTANTS.items()}
    write_day_files(df, f"{tmp_dir}/days")
    back = {r["s"]: str(r["dt"]) for r in spark.read.parquet(f"{tmp_dir}/days").collect()}
    assert back == {s: v[3] for s, v in INSTANTS.items()}


def test_only_local_mode_falls_back_to_a_private_folder(spark):
    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
