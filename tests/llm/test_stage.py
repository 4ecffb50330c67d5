from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

from daybook.llm import stage


def test_threads_record_their_own_tables(spark):
    """Two pipelines at a time: neither may drop what the other has made."""
    together = Barrier(2)

    def work(n):
        with stage.recording() as outer, stage.recording() as inner:
            together.wait()
            df = stage.cut(spark.range(n), f"thread{n}")
            together.wait()
        assert outer == inner and len(outer) == 1
        return outer[0], df.count()

    with ThreadPoolExecutor(2) as pool:
        (one, n), (other, m) = pool.map(work, (3, 4))
    assert one != other and (n, m) == (3, 4)


def test_recordings_end_in_any_order(spark):
    first, second = stage.recording(), stage.recording()
    made, more = first.__enter__(), second.__enter__()
    first.__exit__(None, None, None)
    stage.cut(spark.range(1), "later")
    second.__exit__(None, None, None)
    assert made == [] and len(more) == 1
