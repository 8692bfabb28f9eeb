import pandas as pd


def normalise(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]")
        elif pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype("float64")
        elif pd.api.types.is_integer_dtype(df[c]):
            df[c] = df[c].astype("Int64")
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def assert_same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(normalise(got), normalise(want), check_dtype=False, check_exact=True)


def envelope_rows(spark, values, schema_ts=None):
    """Topic records from raw message texts (None = null value)."""
    import datetime as dt
    from meterstream.schema import ENVELOPE_SCHEMA
    ts = schema_ts or dt.datetime(2024, 1, 1)
    rows = [(None if v is None else b"k", None if v is None else v.encode(), "t", 0, i, ts, 0)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


class FailOnce:
    """Wraps a sink and fails its first write."""

    def __init__(self, sink):
        self.sink, self.failed = sink, False

    def write(self, df, batch):
        if not self.failed:
            self.failed = True
            raise RuntimeError("injected sink failure")
        self.sink.write(df, batch)
