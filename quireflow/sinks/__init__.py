"""Writers for images, judgments, texts, summaries and metadata."""
