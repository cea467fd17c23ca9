from geonest.streaming.news_stream import run_news_stream_once, start_news_stream  # noqa: F401
