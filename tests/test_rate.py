"""One rate for the whole run."""

import time

from walletflow.operators.fetch import FetchOptions, fetch_rounds


class LimitedService:
    """Answers at most ``limit`` calls within a second, over all worker processes; the rest get 429."""

    def __init__(self, path, limit):
        self.path, self.limit = path, limit

    def __call__(self, req):
        import fcntl

        with open(self.path, "a+") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            f.seek(0)
            now = time.time()
            recent = sum(now - float(x) < 1 for x in f.read().split())
            f.write(f"{now}\n")
        if recent >= self.limit:
            return 429, None
        return 200, "{}"


def keys(spark, n):
    return spark.createDataFrame([("0x" + f"{k:040x}",) for k in range(n)], "address string")


def options(**more):
    return FetchOptions(kind="labels", backoff_429=0.0, round_delay=0.0, max_partitions=4, **more)


def test_rate_stays_below_the_services_limit(spark, tmp_dir):
    opts = options(calls_per_sec=25.0, keys_per_partition=20)
    run = fetch_rounds(keys(spark, 80), LimitedService(f"{tmp_dir}/calls", 40), opts)
    assert run.n_success == 80 and run.rounds == 1 and run.elapsed_sec >= 2.5
    assert [(r.attempted, r.throttled, r.rate, r.next_rate) for r in run.rates().collect()] == [(80, 0, 25.0, 25.0)]
    with open(f"{tmp_dir}/calls") as f:
        at = sorted(map(float, f.read().split()))
    assert all(sum(t <= u < t + 1 for u in at) <= 40 for t in at)


def test_rate_is_lowered_until_every_key_is_answered(spark, tmp_dir):
    opts = options(calls_per_sec=400.0, keys_per_partition=10, slow_down=0.3)
    run = fetch_rounds(keys(spark, 120), LimitedService(f"{tmp_dir}/calls", 30), opts)
    assert run.n_success == 120 and run.dead_letters().count() == 0
    rates = run.rates().orderBy("round", "wave").collect()
    assert rates[0].rate == 400.0 and min(r.rate for r in rates) < 100
    for one, other in zip(rates, rates[1:]):
        assert other.rate == one.next_rate
        assert one.next_rate < one.rate if one.throttled > 0.01 * one.attempted else one.next_rate >= one.rate


def test_resumed_run_keeps_its_rate(spark, tmp_dir):
    opts = options(calls_per_sec=400.0, slow_down=0.5, max_rounds=2)
    service = LimitedService(f"{tmp_dir}/calls", 5)
    first = fetch_rounds(keys(spark, 40), service, opts, landing=f"{tmp_dir}/landing")
    again = fetch_rounds(keys(spark, 40), service, opts, landing=f"{tmp_dir}/landing")
    assert sorted(map(str, first.rates().collect())) == sorted(map(str, again.rates().collect()))
    more = options(calls_per_sec=400.0, slow_down=0.5, max_rounds=3)
    third = fetch_rounds(keys(spark, 40), service, more, landing=f"{tmp_dir}/landing").rates().orderBy("round").collect()
    assert third[2].rate == third[1].next_rate == 100.0


def test_without_a_limit_nothing_is_decided(spark):
    run = fetch_rounds(keys(spark, 3), lambda req: (200, "{}"), options(request_delay=0.0))
    assert run.rates().count() == 0
