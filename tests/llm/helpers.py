"""Small tables with the awkward cases, and plain re-statements of the operators."""

import re
import zlib

DOC_SCHEMA = "doc_id long, text string, label string, n long, hit string"


def docs(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], DOC_SCHEMA)


def words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def key(row):
    return tuple((x is not None, x) for x in row)
