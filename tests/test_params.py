"""A6-A8, C3, C8, D7, E6 on the fixture parameter table."""

import datetime as dt

from pyspark.sql import functions as F

from assetlens import operators as op
from assetlens.sources import fixtures as fx


def norm(spark, rows=None):
    return op.normalise_params(fx.model_params(spark, rows))


def ids(df):
    return sorted(r.model_id for r in df.select("model_id").collect())


def test_active_and_runnable(spark):
    n = norm(spark)
    active = op.active_params(n, as_of=fx.AS_OF)
    assert ids(active) == ["m1", "m2", "m6", "m7"]          # m3 off, m4 child 3, m5 too new
    assert ids(op.runnable_params(active)) == ["m1", "m2", "m7"]
    rej = op.rejected_params(active).collect()
    assert [(r.model_id, r.reason) for r in rej] == [("m6", "unsupported_result_span")]
    assert ids(op.active_params(n, child_type=3, as_of=fx.AS_OF)) == ["m4"]
    # ten minutes later m5 qualifies
    later = fx.AS_OF + dt.timedelta(minutes=10)
    assert "m5" in ids(op.active_params(n, as_of=later))
    assert ids(op.model_gate(n)) == ["m1", "m2", "m4", "m5", "m6", "m7"]


def test_stringly_typed_params(spark):
    rows = [("x1", " 1 ", "1", "hh", "1.0", "1", "", "0.9", "1", "yes", "TRUE", "1",
             '{"model_entity_group":"A"}', None, dt.datetime(2020, 1, 1))]
    schema = ", ".join(f"{f.name} {'timestamp' if f.name == 'modify_time' else 'string'}"
                       for f in fx.PARAMS.fields)
    n = op.normalise_params(spark.createDataFrame(rows, schema)).first()
    assert (n.model_type, n.rate_num, n.span, n.accumulate, n.switch_on, n.task_status, n.entity_group_list) == \
        (1, 1, 1, True, True, "", "A")


def test_diff(spark):
    d = {r.model_id: r for r in op.diff_params(norm(spark), norm(spark, fx.PARAM_ROWS_NEXT)).collect()}
    assert d["m1"].update_changed and not d["m1"].dimension_changed
    assert d["m2"].span_changed and d["m2"].unit_changed and not d["m2"].num_changed and d["m2"].dimension_changed
    assert d["m7"].num_changed and d["m7"].dimension_changed and not d["m7"].update_changed
    assert d["m4"].removed and d["m8"].added
    assert not any([d["m3"].update_changed, d["m3"].dimension_changed, d["m3"].added, d["m3"].removed])


def test_latest(spark):
    later = op.normalise_params(fx.model_params(spark, fx.PARAM_ROWS_NEXT)
                                .withColumn("modify_time", F.col("modify_time") + F.expr("INTERVAL 1 DAY")))
    latest = {r.model_id: r for r in op.latest_params(norm(spark).unionByName(later)).collect()}
    assert latest["m1"].update_mode == 0 and latest["m4"].update_mode == 1 and "m8" in latest
