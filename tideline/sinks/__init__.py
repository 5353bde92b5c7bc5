"""Writers: relational upserts, message topics, search indexes and consoles."""
