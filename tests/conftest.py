import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hearthlake import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build_session(
        "hearthlake-tests",
        master="local[8]",
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def lake(spark, tmp_path):
    from hearthlake.plans.lake import Lake

    return Lake(
        spark,
        str(tmp_path / "lake"),
        apartment_map={"alpha": "apt_a", "beta": "apt_b"},
        building_patterns={"alpha": "apt_a", "beta": "apt_b"},
        weather_sites=["Aadorf / Tänikon", "Sion"],
    )
