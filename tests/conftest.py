from __future__ import annotations

import random
import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from postflow.session import build_session  # noqa: E402

DATA = Path("/root/testdata")
START = datetime(2023, 1, 2, 3, 15, 54)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "postflow-tests", "local[8]", spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path)


def csv_rows() -> list[tuple]:
    """80 posts by 80 users, most of them with texts of several lines."""
    draw = random.Random(11)
    words = 'share "style" evening, budget café o\'clock news'.split()
    rows = []
    for number in range(1, 81):
        lines = [" ".join(draw.choices(words, k=draw.randint(3, 12)))
                 for _ in range(draw.randint(1, 4))]
        when = START + timedelta(seconds=draw.randrange(10_000_000))
        rows.append((number, f"author{number}", "\n".join(lines), draw.randrange(100),
                     draw.randrange(100), when))
    return rows


@pytest.fixture(scope="session")
def post_csv(tmp_path_factory):
    """A file of those posts, with CR LF between records and a last record that is cut short."""
    path = tmp_path_factory.mktemp("csv") / "posts.csv"
    text = "Tweet_ID,Username,Text,Retweets,Likes,Timestamp\r\n"
    for number, user, post, retweets, likes, when in csv_rows():
        quoted = post.replace('"', '""')
        text += f'{number},{user},"{quoted}",{retweets},{likes},{when}\r\n'
    path.write_bytes((text + '81,author81,"Cut in the\nmiddle of').encode())
    return str(path)


def at(minute: int, second: int = 0, hour: int = 11, day: int = 1) -> datetime:
    return datetime(2024, 1, day, hour, minute, second, tzinfo=timezone.utc)


def rows_of(frame, *columns):
    """Rows as sorted tuples, of some columns if named."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in frame.collect()), key=repr)
