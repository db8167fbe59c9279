"""Declared schemas of the input tables and text streams."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
}


def _schema(text: str) -> T.StructType:
    """Schema of ``name type`` entries; needs no running session."""
    entries = (entry.split() for entry in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in entries])


MOVIES = _schema(
    "mid long, movie_name string, img_urls string, directors string, screen_writer string, "
    "main_actors string, categories string, location string, language string, "
    "release_date string, run_time string, alias string, summery string, rating_num double, "
    "off_shelf int, hot_degree int, view_num long, play_url string"
)
RATINGS = _schema("rating_id long, uid long, mid long, rating double, date string")
COMMENTS = _schema(
    "comment_id string, uid long, mid long, content string, date string, deleted int, "
    "like_num int, dislike_num int"
)
PLAYS = _schema(
    "scan_id string, uid long, mid long, movie_name string, image string, date string, deleted int"
)
COLLECTIONS = _schema(
    "collection_id string, mid long, uid long, image string, movie_name string, date string, "
    "deleted int"
)
USERS = _schema(
    "userId long, userName string, nickName string, age int, professional string, city string, "
    "sex int"
)
ACTIONS = _schema(
    "date long, userId long, sessionId string, pageId string, searchKeyword string, "
    "clickCategoryId long, collectCategoryId long, ratingCategoryId long, commentCategoryId long, "
    "clickMovieId long, collectMovieId long, ratingMovieId long, commentMovieId long, cityId long"
)
CITIES = _schema(
    "id int, name string, pid int, sname string, level int, cityCode int, yzCode int, "
    "mername string, lng double, lat double, pinyin string"
)
SIMILARITY = _schema("mid long, mid2 long, score double")

# Pipe-separated text streams.
RATING_LINE = _schema("uid long, mid long, rating double, date string")
LOG_LINE = _schema("uid long, ip string, mid long, event string, timestamp long")
LOGIN_LINE = _schema("uid long, ip string, eventType string, timestamp long")
