import gzip
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
FIXTURES = Path(__file__).resolve().parent / "fixtures"
SF = "/root/testdata/sf0.001"
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("citeloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def corpus(tmp_path_factory):
    """The numbered fixtures as the gzipped corpus files they stand for."""
    folder = tmp_path_factory.mktemp("corpus")
    for xml in sorted(FIXTURES.glob("pubmed*.xml")):
        with gzip.open(folder / f"{xml.name}.gz", "wb") as out:
            out.write(xml.read_bytes())
    return str(folder)


@pytest.fixture(scope="session")
def scan(spark):
    from citeloom.sources import xml

    def read(name):
        return xml.scan_articles(spark, str(FIXTURES / name))

    return read


def rows(df, *order):
    """Rows as tuples, ordered by the given columns or by all."""
    names = list(order) or df.columns
    return [tuple(r) for r in df.orderBy(*names).collect()]
