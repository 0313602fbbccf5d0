import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from trendlake import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__default__parallelism="2", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """All rows as sorted tuples."""
    return sorted((tuple(row) for row in df.select(*columns or df.columns).collect()), key=repr)


CSV_COLUMNS = (
    "video_id trending_date title channel_title category_id publish_time tags views likes dislikes comment_count "
    "thumbnail_link comments_disabled ratings_disabled video_error_or_removed description region"
).split()


def bronze(spark, *records, **extra):
    """CSV-form bronze rows; what a record leaves out gets a plain value."""
    plain = dict(
        video_id="v1", trending_date="17.14.11", title="t", channel_title="c", category_id="10",
        publish_time="2017-11-13T17:13:01.000Z", tags="a|b", views="200", likes="7", dislikes="1", comment_count="3",
        thumbnail_link="http://x", comments_disabled="False", ratings_disabled="False",
        video_error_or_removed="False", description="d", region="US",
    )
    names = CSV_COLUMNS + list(extra)
    data = [tuple({**plain, **record}.get(name) for name in names) for record in records]
    schema = ", ".join([f"{name} string" for name in CSV_COLUMNS] + [f"{k} {v}" for k, v in extra.items()])
    return spark.createDataFrame(data, schema)
