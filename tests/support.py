"""Constants and helpers of the tests (a module of its own name: several
folders hold a ``conftest``)."""
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


def rows(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda t: tuple((v is not None, v if v is not None else 0) for v in t))
