"""vigil: a Spark-native pipeline for credential-exposure monitoring.

Delimited ``identifier<delim>secret`` text is parsed, cleaned and rejected
line by line with Spark column expressions, then turned into protected
records that carry only keyed HMAC-SHA256 digests, the secret's hash
scheme and the source path.  Maintenance, audit and exposure-check jobs
run over those protected records.  No sink or query result holds a
clear identifier or secret.
"""

__version__ = "0.1.0"
