"""Table, file, payload and stream sources, and the quarantine split."""
