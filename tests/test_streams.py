"""Silver and Bronze from arriving files, against one batch run over all of them."""

from pathlib import Path

from aerolith.operators import bronze, silver
from aerolith.sources import files, tables
from aerolith.streaming.bronze_stream import stream_bronze
from aerolith.streaming.silver_stream import merge_arrival, stream_silver
from tests.conftest import rows_of

ARRIVALS = (
    [{"flight_num": "1"}, {"flight_num": "2"}, {"flight_num": "2", "arr_delay": 20.0}, {"flight_num": None}],
    # a correction, a repeat, a later null key, a row that cleaning drops, a new month
    [
        {"flight_num": "1", "arr_delay": 99.0},
        {"flight_num": "2", "arr_delay": 20.0},
        {"flight_num": None, "arr_delay": 3.0},
        {"flight_num": "2", "arr_delay": 1.0, "cancelled": 1},
        {"month": 2, "flight_num": "3"},
    ],
    [{"month": 2, "flight_num": "3", "arr_delay": -4.0}, {"month": 3, "flight_num": "4"}],
)


class Delivery:
    """A folder, a table and a stream between them."""

    def __init__(self, spark, flights, folder):
        self.spark, self.flights = spark, flights
        self.arrivals, self.path, self.checkpoint = folder("arrivals"), folder("silver"), folder("checkpoint")
        self.count = 0

    def arrive(self, rows):
        target = Path(self.arrivals)
        target.mkdir(exist_ok=True)
        written = f"{self.arrivals}-{self.count}"
        self.flights(*rows).coalesce(1).write.parquet(written)
        (part,) = Path(written).glob("part-*.parquet")
        part.rename(target / f"arrival-{self.count:03}.parquet")
        self.count += 1
        self.run()

    def run(self):
        schema = self.flights({}).schema
        stream_silver(
            self.spark, self.arrivals, self.path, self.checkpoint, schema, file_format="parquet"
        ).awaitTermination()

    def table(self):
        return rows_of(tables.read_table(self.spark, self.path))


def test_arrivals_give_the_table_of_one_batch_run(spark, flights, folder):
    delivery = Delivery(spark, flights, folder)
    for rows in ARRIVALS:
        delivery.arrive(rows)
    whole = files.with_ingest_order(spark.read.parquet(delivery.arrivals), "parquet")
    expected = rows_of(silver.silver_frame(whole))
    assert delivery.table() == expected
    assert len(expected) == 5


def test_only_touched_months_are_rewritten(spark, flights, folder):
    delivery = Delivery(spark, flights, folder)
    delivery.arrive(ARRIVALS[0])
    before = {p for p in Path(delivery.path).rglob("month=1/*.parquet")}
    delivery.arrive(ARRIVALS[2])
    assert {p for p in Path(delivery.path).rglob("month=1/*.parquet")} == before


def test_a_repeated_micro_batch_changes_nothing(spark, flights, folder):
    delivery = Delivery(spark, flights, folder)
    for rows in ARRIVALS[:2]:
        delivery.arrive(rows)
    before, version = delivery.table(), tables.latest_version(spark, delivery.path)
    done = Path(delivery.checkpoint, "commits")
    (done / "1").unlink()  # as if the driver had died before it could note the micro-batch as done
    (done / ".1.crc").unlink(missing_ok=True)
    delivery.run()
    assert (done / "1").exists()
    assert delivery.table() == before
    assert tables.latest_version(spark, delivery.path) == version


def test_an_attempt_that_died_before_its_commit_is_replaced(spark, flights, folder):
    path = folder()
    raw = flights(*ARRIVALS[0]).selectExpr(
        "*", "'f' AS ingest_file", "0L AS ingest_block", "CAST(seq AS bigint) AS ingest_row"
    )
    half = silver.silver_frame(raw).filter("flight_num = '1'")
    tables.write_load(half, path, silver.PARTITIONS, load_id="arrival")
    assert merge_arrival(spark, path, raw, "arrival")
    assert tables.read_table(spark, path).count() == 3
    assert not merge_arrival(spark, path, raw, "arrival")
    assert tables.read_table(spark, path).count() == 3


def test_arrivals_without_a_usable_row(spark, flights, folder):
    delivery = Delivery(spark, flights, folder)
    delivery.arrive([{"cancelled": 1}])
    assert tables.latest_version(spark, delivery.path) is None
    delivery.arrive(ARRIVALS[0])
    delivery.arrive([{"arr_delay": None}])
    assert len(delivery.table()) == 3


def test_csv_arrivals_keep_malformed_records_apart(spark, flights, folder):
    arrivals, schema = Path(folder("arrivals")), flights({}).schema
    arrivals.mkdir()
    columns = ",".join(schema.names)
    sound = "2018,1,7,aa,10,jfk,lax,1230,5.0,10.0,0,0"
    (arrivals / "a.csv").write_text(f"{columns}\n{sound}\n2018,1,7,aa\n")
    bronze_path, silver_path = folder("bronze"), folder("silver")
    for load, path in ((stream_bronze, bronze_path), (stream_silver, silver_path)):
        load(spark, str(arrivals), path, folder("checkpoint"), schema, file_format="csv").awaitTermination()
    assert bronze.read_bronze(spark, bronze_path).count() == 1
    assert rows_of(bronze.read_quarantine(spark, bronze_path), "record") == [("2018,1,7,aa",)]
    assert tables.read_table(spark, silver_path).count() == 1
