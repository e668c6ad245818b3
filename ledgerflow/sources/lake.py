"""Parquet tables below one base URI (``s3a://bucket``, ``file:/...``)."""

from pyspark.sql import DataFrame, SparkSession

# The settings that must be given.
REQUIRED = ("s3_bucket", "aws_access_key_id", "aws_secret_access_key")


def s3a_options(config: dict) -> dict[str, str]:
    """Session settings for an S3 bucket.

    With ``credentials_provider`` (a provider class) no literal keys are
    needed; otherwise both keys are.
    """
    provider = config.get("credentials_provider")
    required = REQUIRED[:1] if provider else REQUIRED
    missing = [key for key in required if key not in config]
    if missing:
        raise ValueError(f"missing S3 settings: {', '.join(missing)}")
    # Settings of the S3A file system.
    prefix = "spark.hadoop.fs.s3a."
    options = {
        prefix + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        prefix + "multipart.size": str(100 * 1024 * 1024),
        prefix + "fast.upload": "true",
        prefix + "fast.upload.buffer": "disk",
    }
    if provider:
        options[prefix + "aws.credentials.provider"] = provider
    else:
        options[prefix + "access.key"] = config["aws_access_key_id"]
        options[prefix + "secret.key"] = config["aws_secret_access_key"]
    return options


def bucket_uri(config: dict) -> str:
    return f"s3a://{config['s3_bucket']}"


def lake_path(base_uri: str, path: str) -> str:
    return f"{base_uri.rstrip('/')}/{path.strip('/')}"


def read_parquet(spark: SparkSession, base_uri: str, path: str) -> DataFrame:
    return spark.read.parquet(lake_path(base_uri, path))
