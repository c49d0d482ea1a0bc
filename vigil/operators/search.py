"""Post search predicates (PF-1..PF-28) over a stored posts table.

A ``PostFilter`` becomes one conjunctive Column, so every part is pushed into the scan where the
source allows it (Parquet row-group statistics for ts/likes/language, partition pruning on date).
``custom_query`` replaces all other parts; the list filter is a left-semi join with a membership
table; popular/latest with a limit is a top-k (TakeOrderedAndProject).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from vigil.functions.dates import parse_param
from vigil.functions.geo import in_circle
from vigil.operators.joins import broadcast_if_bounded

# Words searched by the e-mail and phone options.
EMAIL_WORDS = ("mail", "email", "gmail", "e-mail")
PHONE_WORDS = ("phone", "call me", "text me")


@dataclass
class PostColumns:
    """Column names of the posts table."""
    id: str = "post_id"
    text: str = "tweet"
    ts: str = "ts"
    username: str = "username"
    to_user: str = "to_user"
    mentions: str = "mentions"
    place: str = "place"
    lat: str = "lat"
    lon: str = "lon"
    geo_cell: str = "geo_cell"  # the place's grid cell, if the table has it: ranges reach the scan
    n_images: str = "n_images"
    n_videos: str = "n_videos"
    n_urls: str = "n_urls"
    verified: str = "verified"
    is_retweet: str = "is_retweet"
    is_reply: str = "is_reply"
    likes: str = "likes"
    retweets: str = "retweets"
    replies: str = "replies"
    source: str = "source"
    language: str = "language"
    date: str = "date"  # the day of ``ts``, if the table has it: partition pruning by since and until


@dataclass
class PostFilter:
    keyword: str | None = None            # PF-1: every term, case-insensitive
    username: str | None = None           # PF-2
    since: str | datetime | None = None   # PF-3 inclusive (text in either layout, PF-6)
    until: str | datetime | None = None   # PF-4 exclusive
    year: int | None = None               # PF-5: before 1 January of that year
    geo: tuple[float, float, float] | str | None = None  # PF-7: lat, lon, radius km ("lat,lon,10km")
    near: str | None = None               # PF-8
    email: bool = False                   # PF-9
    phone: bool = False                   # PF-10
    verified: bool = False                # PF-11
    to: str | None = None                 # PF-12
    all: str | None = None                # PF-13: to OR from OR mentioning
    images: bool = False                  # PF-14
    videos: bool = False                  # PF-15
    media: bool = False                   # PF-16
    replies: bool = False                 # PF-17
    native_retweets: bool = False         # PF-18
    min_likes: int | None = None          # PF-19
    min_retweets: int | None = None       # PF-20
    min_replies: int | None = None        # PF-21
    links: str | None = None              # PF-22: "include" | "exclude"
    source: str | None = None             # PF-23
    members_list: str | None = None       # PF-24 (needs a membership table)
    filter_retweets: bool = False         # PF-25
    custom_query: str | None = None       # PF-26: SQL predicate replacing all others
    lang: str | None = None               # PF-27
    popular: bool = False                 # PF-28: order by likes instead of time
    limit: int | None = None              # PF-28
    cols: PostColumns = field(default_factory=PostColumns)


def _parse_geo(geo) -> tuple[float, float, float]:
    if isinstance(geo, str):
        lat, lon, rad = geo.replace(" ", "").split(",")
        return float(lat), float(lon), float(rad.lower().removesuffix("km"))
    lat, lon, rad = geo
    return float(lat), float(lon), float(rad)


def _any_word(text: Column, words_: tuple[str, ...]) -> Column:
    low = F.lower(text)
    cond = None
    for w in words_:
        c = low.contains(w)
        cond = c if cond is None else (cond | c)
    return cond


def _ts_lit(value: datetime, ts_type) -> Column:
    """A timestamp literal of the column's own type (TIMESTAMP or TIMESTAMP_NTZ)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(ts_type)


def predicate(f: PostFilter, schema=None) -> Column | None:
    """The conjunction of the set options (None when nothing is set)."""
    c = f.cols
    ts_type = schema[c.ts].dataType if schema is not None and c.ts in schema.names else "timestamp"
    if f.custom_query:
        return F.expr(f.custom_query)
    parts: list[Column] = []
    col = F.col
    if schema is not None and c.date in schema.names and isinstance(schema[c.date].dataType, DateType):
        if f.since:
            parts.append(col(c.date) >= F.lit(parse_param(f.since).date()))
        if f.until:
            parts.append(col(c.date) <= F.lit(parse_param(f.until).date()))
    if f.keyword:
        low = F.lower(col(c.text))
        parts += [low.contains(t.lower()) for t in f.keyword.split()]
    if f.username:
        parts.append(col(c.username) == f.username)
    if f.geo:
        cell = col(c.geo_cell) if schema is not None and c.geo_cell in schema.names else None
        parts.append(in_circle(col(c.lat), col(c.lon), _parse_geo(f.geo), cell))
    if f.year:
        parts.append(col(c.ts) < _ts_lit(datetime(int(f.year), 1, 1), ts_type))
    if f.since:
        parts.append(col(c.ts) >= _ts_lit(parse_param(f.since), ts_type))
    if f.until:
        parts.append(col(c.ts) < _ts_lit(parse_param(f.until), ts_type))
    if f.email:
        parts.append(_any_word(col(c.text), EMAIL_WORDS))
    if f.phone:
        parts.append(_any_word(col(c.text), PHONE_WORDS))
    if f.verified:
        parts.append(col(c.verified))
    if f.to:
        parts.append(col(c.to_user) == f.to)
    if f.all:
        parts.append((col(c.to_user) == f.all) | (col(c.username) == f.all)
                     | F.coalesce(F.array_contains(col(c.mentions), f.all), F.lit(False)))
    if f.near:
        parts.append(col(c.place) == f.near)
    if f.images:
        parts.append(col(c.n_images) > 0)
    if f.videos:
        parts.append(col(c.n_videos) > 0)
    if f.media:
        parts.append((col(c.n_images) > 0) | (col(c.n_videos) > 0))
    if f.replies:
        parts.append(col(c.is_reply))
    if f.native_retweets:
        parts.append(col(c.is_retweet))
    if f.min_likes is not None:
        parts.append(col(c.likes) >= f.min_likes)
    if f.min_retweets is not None:
        parts.append(col(c.retweets) >= f.min_retweets)
    if f.min_replies is not None:
        parts.append(col(c.replies) >= f.min_replies)
    if f.links == "include":
        parts.append(col(c.n_urls) > 0)
    elif f.links == "exclude":
        parts.append(col(c.n_urls) == 0)
    if f.source:
        parts.append(col(c.source) == f.source)
    if f.filter_retweets:
        parts.append(~col(c.is_retweet))
    if f.lang:
        parts.append(col(c.language) == f.lang)
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def search_posts(df: DataFrame, f: PostFilter, lists: DataFrame | None = None, list_user_col: str = "username",
                 list_id_col: str = "list_id") -> DataFrame:
    """Rows of ``df`` matching the filter; ordered and limited only when a limit is set."""
    c = f.cols
    cond = predicate(f, df.schema)
    out = df.where(cond) if cond is not None else df
    if f.members_list and not f.custom_query:
        if lists is None:
            raise ValueError("members_list needs a membership table")
        members = lists.where(F.col(list_id_col) == f.members_list).select(
            F.col(list_user_col).alias("__member")).distinct()
        members = broadcast_if_bounded(members)
        out = out.join(members, F.col(c.username) == F.col("__member"), "left_semi")
    if f.limit is not None:
        order = [F.desc(c.likes), F.asc(c.id)] if f.popular else [F.desc(c.ts), F.asc(c.id)]
        out = out.orderBy(*order).limit(f.limit)
    return out
