"""The command line runs the pipelines."""

from datetime import date
from types import SimpleNamespace

import pytest

from jobs import database_table, parser, run
from urbanflux import schemas
from urbanflux.plans.pipelines import load_seed
from urbanflux.plans.warehouse import Warehouse
from urbanflux.session import shared_folder

SENSOR = schemas.columns(
    "sensor_id string, location_name string, latitude double, longitude double, status string,"
    " installation_date date"
)


def test_calendar_merge_and_view(spark, folder):
    root = f"{folder}/wh"
    wh = Warehouse(spark, root)
    sensors = spark.createDataFrame([("S1", "Here", 1.0, 2.0, "ACTIVE", date(2026, 1, 1))], SENSOR)
    load_seed(wh, "sensors", sensors, "sensor_id")
    for line in ("calendar 2026-01-01 2026-01-03", "scd2",
                 f"view v_congestion_analysis {folder}/view"):
        run(spark, parser().parse_args(["--warehouse", root, *line.split()]))
    assert wh.dimension("dim_date").current(spark).count() == 3
    assert wh.current_dimension("dim_sensors").first()["sensor_id"] == "S1"
    assert "congestion_level" in spark.read.parquet(f"{folder}/view").columns


def test_database_options_keep_the_password_off_the_command_line(folder, monkeypatch):
    path = f"{folder}/options.json"
    with open(path, "w") as file:
        file.write('{"user": "u", "fetchsize": "5000"}')
    monkeypatch.setenv("JDBC_PASSWORD", "secret")
    line = f"--warehouse w scd2 --jdbc-url jdbc:x:y --jdbc-options {path} --partition-column id"
    args = parser().parse_args([*line.split(), "--lower", "0", "--upper", "9", "--partitions", "4"])
    assert database_table(args, "sensors").options() == {
        "url": "jdbc:x:y", "dbtable": "oltp.sensors", "user": "u", "fetchsize": "5000",
        "password": "secret", "partitionColumn": "id", "lowerBound": "0", "upperBound": "9",
        "numPartitions": "4",
    }


def test_a_cluster_must_name_its_shared_folder():
    def session(master, **conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=SimpleNamespace(master=master))

    named = {"spark.checkpoint.dir": "hdfs:///shared/", "spark.sql.warehouse.dir": "/here"}
    assert shared_folder(session("yarn", **named)) == "hdfs:///shared"
    assert shared_folder(session("local[2]", **{"spark.sql.warehouse.dir": "/here"})) == "/here/scratch"
    with pytest.raises(ValueError):
        shared_folder(session("spark://head:7077", **{"spark.sql.warehouse.dir": "/here"}))
