from tablaris.operators.conform import apply_types, conform
from tablaris.operators.regression import LinearModel, predict
from tablaris.operators.validate import spec_validity
from tablaris.plans.presets import ENERGY
from tablaris.streaming.row_local import write_stream

MODEL = LinearModel(("temperatura", "hora"), "consumo_energia", 1.0, (2.0, -1.0), "energia")


def readings(df):
    """Conform, type, validate and predict: every step looks at one row only."""
    typed = apply_types(conform(df, ENERGY), ENERGY)
    return predict(typed.where(spec_validity(ENERGY)), MODEL)


def test_row_local_chain_gives_the_same_rows_on_a_stream(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    raw = spark.range(300).selectExpr(
        "concat(id, ',5') AS Temperature",
        "cast(id % 27 AS string) AS HOUR",
        "cast(id % 7 + 1 AS string) AS day_of_week",
        "if(id % 10 = 0, 'n/a', cast(id AS string)) AS energy_consumption",
    )
    raw.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(raw.schema).parquet(source)
    write_stream(stream, readings, sink, checkpoint).awaitTermination()
    got = spark.read.parquet(sink)
    assert sorted(got.collect()) == sorted(readings(raw).collect())
    assert 0 < got.count() < 300

    # A restart from the same checkpoint finds nothing new.
    before = got.count()
    write_stream(stream, readings, sink, checkpoint).awaitTermination()
    assert spark.read.parquet(sink).count() == before
