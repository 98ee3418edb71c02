import pytest
from pyspark.sql import functions as F

from shredline.functions.fields import read_catalogue
from shredline.operators.enrich import create_view
from shredline.sources.records import JdbcRecords, RecordKeyError, RowRecords, check_records, supported
from shredline.sources.staging import shared_folder
from shredline.sources.store import iceberg_settings


@pytest.fixture
def database(spark, tmp_path):
    """An embedded database with records, through the driver that Spark has."""
    jvm = spark._jvm
    jvm.java.lang.Class.forName("org.apache.derby.jdbc.EmbeddedDriver")
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    connection = jvm.java.sql.DriverManager.getConnection(url)
    statement = connection.createStatement()
    statement.execute("CREATE TABLE account (recid VARCHAR(255) NOT NULL PRIMARY KEY, n INT, xmlrecord VARCHAR(4000), currency VARCHAR(250))")
    for k in range(20):
        statement.execute(f"INSERT INTO account VALUES ('r{k}', {k}, '<row><c1>{k}</c1></row>', 'EGP')")
    connection.close()
    return url


def test_jdbc_reads(spark, database, monkeypatch):
    one = JdbcRecords(database, "SELECT recid, n, xmlrecord, currency FROM account WHERE n < 15")
    assert one.read(spark).columns == ["recid", "xmlrecord", "currency"] and one.read(spark).count() == 15
    many = JdbcRecords(database, "SELECT recid, n, xmlrecord, currency FROM account", partition_column="N", bounds=("0", "20"), partitions=4, since="n >= 5")
    rows = many.read(spark)
    assert rows.rdd.getNumPartitions() == 4 and sorted(int(r.recid[1:]) for r in rows.collect()) == list(range(5, 20))
    with pytest.raises(ValueError):
        JdbcRecords(database, "SELECT 1", partition_column="N").settings()
    monkeypatch.setenv("MY_USER", "u")
    monkeypatch.setenv("MY_PASSWORD", "p")
    settings = JdbcRecords("jdbc:x", "q", "MY_USER", "MY_PASSWORD", {"fetchsize": "9"}).settings()
    assert settings == {"url": "jdbc:x", "user": "u", "password": "p", "query": "q", "fetchsize": "9"}


def test_record_keys(spark):
    fine = RowRecords([("a", None, None), ("b", None, None)]).read(spark)
    assert check_records(fine).count() == 2
    for bad in ([("a", None, None), ("a", "x", None)], [(None, "x", None)]):
        with pytest.raises(RecordKeyError):
            check_records(RowRecords(bad).read(spark))


def test_unsupported_types(spark):
    rows = spark.range(1).select("id", F.array("id").alias("many"), F.lit(1).cast("decimal(9,2)").alias("d"))
    assert supported(rows).columns == ["id", "d"]
    assert supported(rows, "convert").first().many == '{"value":[0]}'
    with pytest.raises(TypeError, match="many"):
        supported(rows, "fail")


def test_iceberg_settings():
    made = iceberg_settings("lake", "http://rest:8181", "s3://bucket/", "http://store:9000", "us-east-1")
    assert made["spark.sql.catalog.lake.type"] == "rest" and made["spark.sql.catalog.lake.uri"] == "http://rest:8181"
    assert made["spark.sql.catalog.lake.s3.path-style-access"] == "true" and len(made) == 8


def test_catalogue_file_and_view(spark, tmp_path):
    (tmp_path / "c.csv").write_text("table_name,field_index,m_index,resolved_name_en,dt\nt,c1,,one,2026-01-02\nt,c2,x,two,never\nt,c2,3,three,\n")
    names = read_catalogue(spark, f"file://{tmp_path}/c.csv")
    assert sorted(((r.field_index, r.multi_value_index, r.field_name, str(r.effective_date)) for r in names.collect()), key=str) == [("c1", None, "one", "2026-01-02"), ("c2", 3, "three", "None"), ("c2", None, "two", "None")]
    rows = spark.createDataFrame([("r", "E", "c2", 3, "v", None), ("r", "E", "c2", None, "w", None)], "recid string, currency string, field_index string, multi_value_index int, field_value string, ingested_at timestamp")
    create_view(rows, names, "named_rows")
    assert sorted((r.field_name, r.field_value) for r in spark.table("named_rows").collect()) == [("three", "v"), ("two", "w")]


class Session:
    """A session without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_the_shared_folder_has_to_be_named():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session(master))
    assert shared_folder(Session("local[8]")) == shared_folder(Session("local[8]"))
