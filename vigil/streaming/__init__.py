"""Incremental form of the daily posts load. The reference itself has no streaming operators
(no watermark, window or state): its daily batch is what ``daily_posts`` runs per arrival."""
