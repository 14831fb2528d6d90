"""Workers are used again by many tasks: what a task has taken may not stay beside the next one's."""

import gc
import os
import subprocess
import sys
import weakref

from corpusloom.llm.common import tidy
from corpusloom.llm.queries import tokenizer_file

GROWTH = """
import gc, random, re, sys
from corpusloom.llm.common import give_back
from corpusloom.llm.packing import WordEncoder

def held():
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

rng = random.Random(1)
for task in range(9):
    text = " ".join("".join(rng.choices("abcdefghij", k=9)) + "1" for _ in range(30_000))
    WordEncoder(sys.argv[1]).encode([text])
    del text
    gc.collect()
    give_back()
    if task == 2:
        before = held()
print(held() - before)
"""


def test_objects_of_a_task_are_gone_at_its_end():
    class Node:
        pass

    kept = []

    def work(batches):
        node = Node()
        node.me = node  # as an encoder and its table refer to each other
        kept.append(weakref.ref(node))
        yield from batches

    gc.disable()
    try:
        assert list(tidy(work)(iter([1, 2]))) == [1, 2]
        assert kept[0]() is None
    finally:
        gc.enable()


def test_encoders_of_earlier_tasks_keep_no_memory():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = subprocess.run([sys.executable, "-c", GROWTH, tokenizer_file()], capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": os.pathsep.join([root, *sys.path])})
    assert float(run.stdout) < 30  # MB over six tasks
