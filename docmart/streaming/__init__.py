from .incremental import DocumentSinks, process_changes, run_incremental, start_document_stream

__all__ = ["DocumentSinks", "process_changes", "run_incremental", "start_document_stream"]
