from .sessions import sessions_to_batches, sessions_to_files, sessions_to_jdbc

__all__ = ["sessions_to_batches", "sessions_to_files", "sessions_to_jdbc"]
