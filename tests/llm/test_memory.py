"""What a step leaves in the driver's memory."""

import gc
import time
from pathlib import Path

import pytest

from rawscan.llm import common


def test_garbage_of_a_step_is_collected_once_it_is_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "_settled", [0.0], raising=False)
    jvm = spark.sparkContext._jvm
    thing = jvm.java.lang.Object()
    left = jvm.java.lang.ref.WeakReference(thing)
    del thing
    gc.collect()
    assert common.stored(spark.range(3), "kept").count() == 3
    assert left.get() is None


def test_what_python_lets_go_of_just_before_is_collected(spark, monkeypatch):
    jvm = spark.sparkContext._jvm
    for _ in range(3):
        thing = jvm.java.lang.Object()
        left = jvm.java.lang.ref.WeakReference(thing)
        del thing
        monkeypatch.setattr(common, "_settled", [float("-inf")])
        common.settle(spark)
        assert left.get() is None


def test_free_native_memory_goes_back_to_the_system(spark, monkeypatch):
    jvm = spark.sparkContext._jvm
    said = Path(f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup")
    if not said.exists() or jvm.Runtime.version().compareTo(jvm.java.lang.Runtime.Version.parse("17.0.9")) < 0:
        pytest.skip("needs /proc and a JVM that can trim its native heap")
    anonymous = lambda: next(int(x.split()[1]) for x in said.read_text().splitlines() if x.startswith("Pss_Anon")) / 1024
    buffers = [jvm.java.nio.ByteBuffer.allocateDirect(60_000) for _ in range(3000)]
    kept = buffers[::50]  # so the allocator can't shrink its heaps from their ends
    del buffers
    gc.collect()
    jvm.System.gc()
    time.sleep(1)  # buffers are freed by a thread of the JVM
    before = anonymous()
    monkeypatch.setattr(common, "_settled", [float("-inf")])
    common.settle(spark)
    assert before - anonymous() > 100
    assert len(kept) == 60
