"""vocalis: Spark-native speech-recognition evaluation and audio feature engine.

Sub-packages
------------
sources     readers and writers (audio files, result tables, pair files, profiles)
functions   Column-level expressions (WER, tokenisation, formatting, ...)
operators   DataFrame operators (reports, knowledge-base tables, ordering, audio jobs)
streaming   Structured Streaming jobs (features, reassembly, rate limiting, running WER)
plans       fixture views built from the driver tables and the query catalogue
"""

from vocalis.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
