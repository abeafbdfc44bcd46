"""Declared schemas of the landed records; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in kinds.items()])


STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()

# Times are read as text and parsed by ``parse_utc``, so a bad one becomes null
# without losing the record.
REVISION_META = _fields(
    title=STRING,
    id=LONG,
    timestamp=STRING,
    user=_fields(id=LONG, name=STRING),
    comment=STRING,
    size=LONG,
    delta=LONG,
    minor=T.BooleanType(),
)
# ``type`` and ``lineNumber`` are those of the hunk; ``piece`` is absent as landed.
REVISION_CONTENT = _fields(
    from_id=STRING, to_id=STRING, title=STRING, date=STRING, piece=LONG,
    type=INT, lineNumber=INT, text=STRING,
)
MIXED = T.StructType(
    REVISION_META.fields + [f for f in REVISION_CONTENT.fields if f.name != "title"]
)
ARTICLE = _fields(title=STRING, text=STRING)
WORD = _fields(word=STRING)
WORD_FREQUENCY = _fields(word=STRING, freq=T.DoubleType())
MONTHLY = _fields(year=INT, month=INT, total_uncommon_words=LONG)
SENTENCE_STATS = _fields(
    to_id=STRING,
    date=STRING,
    avg_word_count=T.DoubleType(),
    variance=T.DoubleType(),
    relative_variance=T.DoubleType(),
)

TOP_VIEWS = _fields(
    items=T.ArrayType(_fields(articles=T.ArrayType(_fields(article=STRING, views=LONG))))
)
PAGE_VIEWS = _fields(items=T.ArrayType(_fields(article=STRING, timestamp=STRING, views=LONG)))
REGISTRATIONS = _fields(
    items=T.ArrayType(
        _fields(results=T.ArrayType(_fields(timestamp=STRING, new_registered_users=LONG)))
    )
)
CATEGORY_MEMBERS = _fields(query=_fields(categorymembers=T.ArrayType(_fields(title=STRING))))
_MAIN_SLOT = _fields(main=_fields(content=STRING))
PAGE_MAP = _fields(
    query=_fields(
        pages=T.MapType(
            STRING,
            _fields(
                title=STRING,
                revisions=T.ArrayType(_fields(slots=_MAIN_SLOT, timestamp=STRING, comment=STRING)),
            ),
        )
    )
)
REVISION_LISTING = _fields(
    title=STRING,
    revisions=T.ArrayType(
        _fields(id=LONG, timestamp=STRING, user=STRING, comment=STRING, content=STRING)
    ),
)
DIFF = _fields(diff=T.ArrayType(_fields(type=INT, lineNumber=INT, text=STRING)))
