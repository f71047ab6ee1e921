"""tidelog: analytics over partitioned, offset-addressed event logs on Spark."""

from tidelog.session import build_session, configure
from tidelog.sources.topic_log import TopicLog

__all__ = ["TopicLog", "build_session", "configure"]
