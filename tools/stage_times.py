"""Summarise stage times from a Spark event-log folder (bench run with
REVLENS_EVENT_LOG=<dir>). Reads zstd-compressed or plain event files.

    python tools/stage_times.py <dir> [top]
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def events(path):
    with open(path, "rb") as fh:
        head = fh.read(4)
        fh.seek(0)
        if head == b"\x28\xb5\x2f\xfd":               # zstd frame magic
            import zstandard
            stream = zstandard.ZstdDecompressor().stream_reader(fh)
        else:
            stream = fh
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            yield json.loads(line)


def main():
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = [f for f in glob.glob(os.path.join(root, "**", "*"), recursive=True)
             if os.path.isfile(f) and "appstatus" not in os.path.basename(f)]
    ms = collections.Counter()
    count = collections.Counter()
    for f in files:
        for e in events(f):
            if e.get("Event") == "SparkListenerStageCompleted":
                i = e["Stage Info"]
                name = i["Stage Name"]
                ms[name] += i.get("Completion Time", 0) - i.get("Submission Time", 0)
                count[name] += 1
    for name, t in ms.most_common(top):
        print(f"{t / 1000:8.2f}s  {count[name]:4d} stages  {name}")


if __name__ == "__main__":
    main()
