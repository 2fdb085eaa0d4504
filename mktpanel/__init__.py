"""mktpanel: weekly market-forecast datasets as Spark DataFrame jobs.

Daily prices become weekly returns with class labels, news is attached by
week, fundamentals as of a date, prompts are assembled from a rolling
history, a user-supplied text generator answers them in resumable batches,
answers become a chronologically split dataset, and predicted labels are
scored against realised returns.  Every step is a DataFrame operator over
``(symbol, time)`` tables.
"""

from mktpanel.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
