import pytest
from pyspark.sql import types as T

from tidewatch.schemas import ALERT_SCHEMA, CONN_SCHEMA, DNS_SCHEMA, HTTP_SCHEMA, WIDE_SCHEMA, WIRE_SCHEMA, merge_schemas


def test_field_counts():
    assert (len(CONN_SCHEMA), len(HTTP_SCHEMA), len(DNS_SCHEMA)) == (29, 27, 26)
    assert len(WIRE_SCHEMA) == len(WIDE_SCHEMA) == 65
    assert len(ALERT_SCHEMA) == 12


def test_wide_names_are_flat():
    names = WIDE_SCHEMA.fieldNames()
    assert "id_orig_h" in names and "id.orig_h" not in names
    assert names[:4] == ["@path", "sensor_name", "ts", "uid"]


def test_merge_first_wins_and_conflict_raises():
    a = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])
    b = T.StructType([T.StructField("y", T.StringType()), T.StructField("z", T.LongType())])
    assert merge_schemas(a, b).fieldNames() == ["x", "y", "z"]
    c = T.StructType([T.StructField("x", T.StringType())])
    with pytest.raises(TypeError):
        merge_schemas(a, c)
