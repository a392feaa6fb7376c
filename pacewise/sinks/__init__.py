"""Writers: tables, split files, exports."""
