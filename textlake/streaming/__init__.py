"""File-stream versions of the stateless cleaning step and of vocabulary tracking."""
