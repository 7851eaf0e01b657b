import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

MENU = """<!DOCTYPE html>
<html lang="en"><head><meta charset="utf-8"><title>Menu &amp; prices</title>
<script>var dough = "<p>not shown</p>";</script></head>
<body><ul><li>Rye <b>lo</b>af</li><li>Oat loaf<ol><li>small</li><li>large</li></ol></li></ul>
<table><tr><td>Dough</td><td>by the kilo</td></tr></table><!-- closed on Monday --></body></html>
"""
STARTER = "<title>Dough from a sour starter</title><h2>Feed it daily</h2><p>Flour &amp; water, &quot;nothing else&quot;</p>"
# A term twice, words of a script that do not count, a match in a title only, a text of stop words, apostrophes, folders.
FILES = {
    "bread.txt": "Knead the dough for ten minutes. Leave this dough under a cloth, then bake it.\n",
    "oven.txt": "Steam makes crust: pour water into the hot oven.\n",
    "menu.html": MENU,
    "archive/starter.htm": STARTER,
    "archive/1998/sign.txt": "There it was: no such!\n",
    "archive/1998/letter.txt": "Don't ring; the baker's asleep.\n",
}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def write_files(folder: Path, files: dict[str, str]) -> str:
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(folder)


@pytest.fixture
def sample_folder(tmp_path):
    return write_files(tmp_path / "documents", FILES)
