"""Task failures: a failed first attempt is recomputed from lineage and the
results are unchanged (run in a subprocess whose master allows retries)."""
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, ROOT)
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    from coldspot import registry as RG
    from coldspot.operators import sqlreports as Q
    from coldspot.plans import reports as R
    from coldspot.sources import testbed as TB

    spark = (SparkSession.builder.master(sys.argv[1]).config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    sf = "/root/testdata/sf0.001"
    cat = TB.catalogue(spark, sf)

    @F.udf(T.BooleanType())
    def first_attempt_fails(x):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
            raise RuntimeError("injected task failure")
        return True

    def report(traces, sess_hook):
        c = TB.Catalogue(traces=traces, contents=cat.contents, dids=cat.dids, rses=cat.rses,
                         dslocks=cat.dslocks)
        sess = sess_hook(R.sessions(c))
        pops = sorted((tuple(r) for r in R.popularity_periods(sess, c, RG.PERIODS).collect()), key=repr)
        full = R.unused_full_stats(R.unused_datasets(sess, c, TB.REPORT_DATE, sort=False),
                                   TB.REPORT_DATE)
        top = sorted((tuple(r) for r in Q.unused_topn_report(full, 10, 11).collect()), key=repr)
        return sorted((tuple(r) for r in sess.collect()), key=repr), pops, top

    clean = report(cat.traces, lambda s: s)
    # Failure in the scan stage of the access log.
    faulty_scan = report(cat.traces.filter(first_attempt_fails(F.col("uuid"))), lambda s: s)
    # Failure after a shuffle (on the sessions, before the reports).
    faulty_shuffle = report(cat.traces, lambda s: s.filter(first_attempt_fails(F.col("name"))))
    assert clean == faulty_scan == faulty_shuffle, "results differ after task retries"
    assert len(clean[0]) == 108
    print("OK")
""").replace("ROOT", repr(ROOT))


def _run(master):
    return subprocess.run([sys.executable, "-c", SCRIPT, master], capture_output=True,
                          text=True, timeout=900)


def test_results_survive_task_failures():
    out = _run("local[4,2]")  # one retry per task
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.strip().endswith("OK")


def test_failures_are_really_injected():
    out = _run("local[4,1]")  # no retry: the injected failure must surface
    assert out.returncode != 0
    assert "injected task failure" in out.stderr
