"""Choice of the storage target from configuration."""

from __future__ import annotations

import os
from collections.abc import Mapping

# Setting names and the URI schemes that Hadoop file systems use.
TYPE_SETTING = "CLOUD_STORAGE_TYPE"
TARGETS = {
    "s3": ("S3_BUCKET_NAME", "s3a"),
    "gcs": ("GCS_BUCKET_NAME", "gs"),
}


def storage_target(settings: Mapping[str, str] | None = None) -> str | None:
    """Base URI of the configured bucket, or ``None`` where storage is disabled.

    An unknown type or a missing bucket disables storage and is no error.
    """
    settings = os.environ if settings is None else settings
    bucket_setting, scheme = TARGETS.get(settings.get(TYPE_SETTING, "").lower(), ("", ""))
    bucket = settings.get(bucket_setting)
    return f"{scheme}://{bucket}" if bucket else None
