"""Both modes on a small invented archive: python examples/demo.py [folder]"""

from __future__ import annotations

import json
import os
import sys
import tempfile

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom import cli

COMMENTS = [
    {"id": "k1", "link_id": "t3_q7", "author": "Mira", "body": "Is **this** it? See https://a.example/x", "permalink": "/r/Gardens/comments/q7/first_tomatoes/k1/"},
    {"id": "k2", "link_id": "t3_q7", "author": "HelperBot", "body": "I am a bot."},
    {"id": "k3", "link_id": "t3_q7", "author": "Jo", "body": "> Is this it?\nYes &amp; no, /u/Mira", "permalink": "/r/Gardens/comments/q7/first_tomatoes/k3/"},
    {"id": "k4", "link_id": "t3_q8", "author": "Jo", "body": "[deleted]"},
    {"id": "k5", "link_id": "t3_q9", "author": "Ana", "body": "Water them daily."},
]


def main(folder: str | None = None) -> str:
    folder = folder or tempfile.mkdtemp(prefix="demo-")
    archive, bots = os.path.join(folder, "Gardens_comments.zst"), os.path.join(folder, "bots.txt")
    lines = "".join(json.dumps({"created_utc": 1700000000 + i, "subreddit": "Gardens"} | c) + "\n" for i, c in enumerate(COMMENTS))
    with open(archive, "wb") as f:
        f.write(zstandard.ZstdCompressor().compress(lines.encode()))
    with open(bots, "w") as f:
        f.write("helperbot\n")
    for mode in ([], ["--no-group"]):
        cli.main([archive, "--out", folder, "--bots", bots, *mode])
    cli.main([os.path.join(folder, "Gardens_nogroup/json"), "--out", os.path.join(folder, "again")])
    return folder


if __name__ == "__main__":
    print(main(*sys.argv[1:2]))
