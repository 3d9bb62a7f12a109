"""The stages on tables and directories, and the whole pipeline."""
