"""Streaming answer generation: each landed prompt is answered exactly once."""

from pyspark.sql import functions as F

from mktpanel.plans import generate as G
from mktpanel.plans import panel as P
from mktpanel.plans import prompts as PR
from mktpanel.session import shared_dir
from mktpanel.sources import fixtures as fx
from mktpanel.sources import readers as R
from mktpanel.streaming.answers import answer_stream
from tests.conftest import SF_SMALL


def test_stream_answers_each_prompt_once(spark):
    panel = P.build_panel(fx.prices(spark, SF_SMALL), fx.news(spark, SF_SMALL), fx.basics_long(spark, SF_SMALL))
    prompts = PR.build_prompts(panel, fx.profiles(spark, SF_SMALL), fx.index_members(spark, SF_SMALL), 1, 4)
    landing, answers, ckpt = shared_dir(spark, "landing"), shared_dir(spark, "stream-answers"), shared_dir(spark, "ckpt")
    # Two files land: early weeks first, the rest later.
    prompts.where(F.col("week_idx") < 100).write.parquet(landing, mode="append")
    answer_stream(spark, landing, answers, ckpt, G.canned_generator).awaitTermination()
    first = R.read_answers(spark, answers).count()
    prompts.where(F.col("week_idx") >= 100).write.parquet(landing, mode="append")
    answer_stream(spark, landing, answers, ckpt, G.canned_generator).awaitTermination()
    # A restart with nothing new adds nothing.
    answer_stream(spark, landing, answers, ckpt, G.canned_generator).awaitTermination()
    done = R.read_answers(spark, answers)
    n = prompts.count()
    assert 0 < first < n
    assert done.count() == n == done.select("symbol", "week_idx").distinct().count()
