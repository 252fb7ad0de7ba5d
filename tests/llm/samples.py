"""Values that several tests of this folder use."""

import re

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977} v{i % 1009}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog and runs away from all the other animals of the wood"


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
