
from tidewatch.functions.columns import ipv4_to_long
from tidewatch.operators.enrich import segment_of, service_name, status_message, with_locality


def test_ipv4_to_long(spark):
    df = spark.createDataFrame([("10.10.10.1",), ("255.255.255.255",), ("256.1.1.1",), ("x",), (None,)], "ip string")
    assert [r[0] for r in df.select(ipv4_to_long("ip")).collect()] == [168430081, 4294967295, None, None, None]


def test_locality(spark):
    df = spark.createDataFrame([("10.10.10.7", "10.30.30.1"), ("10.10.11.7", "8.8.8.8"), (None, "bad")],
                               "id_orig_h string, id_resp_h string")
    out = with_locality(df).select("local_orig", "local_resp", segment_of("id_resp_h").alias("seg")).collect()
    assert [tuple(r) for r in out] == [(True, True, "dmz"), (False, False, None), (False, False, None)]


def test_service_and_status(spark):
    df = spark.createDataFrame([(22, 404), (8080, 418), (None, None)], "p int, c int")
    out = df.select(service_name("p"), status_message("c")).collect()
    assert [tuple(r) for r in out] == [("ssh", "Not Found"), ("-", None), ("-", None)]
