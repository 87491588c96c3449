import subprocess
import sys

from tapehouse.plans.fixtures import book_feed, events, trade_feed
from tapehouse.sources.publish import write_feed_files


def test_cli_bronze_then_layers(spark, tmp_dir):
    ev = events(spark, "/root/testdata/sf0.001")
    write_feed_files(trade_feed(ev), f"{tmp_dir}/feed/trades")
    write_feed_files(book_feed(ev), f"{tmp_dir}/feed/book")
    env_py = [sys.executable, "-m", "tapehouse"]
    common = dict(cwd=str(__import__("pathlib").Path(__file__).resolve().parents[1]), timeout=600,
                  capture_output=True, text=True)
    r = subprocess.run(env_py + ["bronze", "--lake", f"{tmp_dir}/lake", "--checkpoints", f"{tmp_dir}/ck",
                                 "--book-files", f"{tmp_dir}/feed/book", "--trade-files", f"{tmp_dir}/feed/trades",
                                 "--available-now", "--tables"], **common)
    assert r.returncode == 0, r.stderr[-2000:]
    r = subprocess.run(env_py + ["layers", "--lake", f"{tmp_dir}/lake", "--tables"], **common)
    assert r.returncode == 0, r.stderr[-2000:]
    assert '"silver_trades": %d' % ev.count() in r.stdout
    assert spark.read.parquet(f"{tmp_dir}/lake/gold/gold_ohlcv_1min").count() > 0
