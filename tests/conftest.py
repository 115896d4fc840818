import sys
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DecimalType

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import database  # noqa: E402
from claimledger.session import local_session  # noqa: E402
from claimledger.sources.billing import Billing  # noqa: E402
from claimledger.sources.schemas import MONEY, SOURCES  # noqa: E402
from claimledger.sources.staging import stage_billing  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoint"))
    session = local_session("tests", 8, "4g", **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return database(SMALL)


@pytest.fixture(scope="session")
def staged(spark):
    return stage_billing(spark, SMALL)


@pytest.fixture(scope="session")
def stored(spark, staged, tmp_path_factory):
    """The staged tables as Parquet, the facts partitioned by practice."""
    root = str(tmp_path_factory.mktemp("billing"))
    for name in SOURCES:
        writer = getattr(staged, name).write
        if name in ("charges", "trans_detail"):
            writer = writer.partitionBy("practice_id")
        writer.parquet(f"{root}/{name}")
    return root


def make_table(spark, name, rows):
    """A table from dicts; columns left out are NULL and amounts may be plain numbers."""
    schema = SOURCES[name]
    for row in rows:
        assert set(row) <= set(schema.names), row

    def value(row, field):
        given = row.get(field.name)
        return Decimal(str(given)) if given is not None and isinstance(field.dataType, DecimalType) else given

    columns = {f.name: [value(row, f) for row in rows] for f in schema.fields}
    return spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(schema)), schema)


def make_billing(spark, **tables) -> Billing:
    return Billing(**{name: make_table(spark, name, tables.get(name, [])) for name in SOURCES})


def dollars(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal(1).scaleb(-MONEY.scale))


def same_rows(left, right):
    names = sorted(left.columns)
    assert names == sorted(right.columns)

    def rows(df):
        return sorted(map(tuple, df.select(*names).collect()), key=repr)

    got, want = rows(left), rows(right)
    assert len(got) == len(want)
    assert got == want
