"""Settings that reach external table catalogues and object stores through Spark's own connectors, if their jars are there."""

from __future__ import annotations

from ..errors import ConfigError
from ..spec import Config


def storage_conf(c: Config) -> dict[str, str]:
    """Hadoop settings for S3-compatible stores; TLS follows the endpoint's scheme."""
    out = {"fs.s3a.access.key": c.s3_access_key_id, "fs.s3a.secret.key": c.s3_secret_access_key, "fs.s3a.endpoint": c.s3_endpoint, "fs.s3a.endpoint.region": c.s3_region}
    if c.s3_endpoint:
        out |= {"fs.s3a.path.style.access": "true", "fs.s3a.connection.ssl.enabled": str(c.s3_endpoint.startswith("https")).lower()}
    return {f"spark.hadoop.{k}": v for k, v in out.items() if v}


def catalog_conf(c: Config, name: str = "lake") -> dict[str, str]:
    """Spark settings of a catalogue plug-in: REST, or JDBC for sqlite and postgresql addresses."""
    if not c.catalog_uri:
        raise ConfigError("catalog_uri is needed for an external catalogue")
    jdbc = c.catalog_uri.startswith(("sqlite://", "postgresql://"))
    out = {"type": "jdbc" if jdbc else "rest", "uri": f"jdbc:{c.catalog_uri.replace('sqlite:///', 'sqlite:')}" if jdbc else c.catalog_uri, "warehouse": c.warehouse, "io-impl": c.io_impl}
    if not jdbc:
        if c.oauth2_server_uri and c.credential:
            out |= {"oauth2-server-uri": c.oauth2_server_uri, "credential": c.credential, "scope": c.scope}
        elif c.token:
            out["token"] = c.token
        if c.sigv4_enabled:
            out |= {"rest.sigv4-enabled": "true", "rest.signing-region": c.signing_region, "rest.signing-name": c.signing_name}
    out |= {"s3.endpoint": c.s3_endpoint, "s3.access-key-id": c.s3_access_key_id, "s3.secret-access-key": c.s3_secret_access_key, "client.region": c.s3_region}
    return {f"spark.sql.catalog.{name}.{k}": v for k, v in out.items() if v}
