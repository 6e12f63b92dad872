"""Kafka option builders. Credentials come from the caller or the environment,
never from source files."""

import os

# Security protocol, mechanism and login module of the brokers.
PROTOCOL = "SASL_SSL"
MECHANISM = "SCRAM-SHA-512"
LOGIN_MODULE = "org.apache.kafka.common.security.scram.ScramLoginModule"


def _quoted(text):
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


def connection(servers, username=None, password=None, ca_location=None):
    """Options shared by source and sink; user and password fall back to
    ``KAFKA_USERNAME`` / ``KAFKA_PASSWORD``. ``ca_location`` is a PEM file that every
    executor can read."""
    username = username or os.environ.get("KAFKA_USERNAME")
    password = password or os.environ.get("KAFKA_PASSWORD")
    options = {"kafka.bootstrap.servers": servers}
    if username:
        if not password:
            raise ValueError("a Kafka user needs a password")
        options.update({
            "kafka.security.protocol": PROTOCOL,
            "kafka.sasl.mechanism": MECHANISM,
            "kafka.sasl.jaas.config": (f"{LOGIN_MODULE} required username={_quoted(username)} "
                                       f"password={_quoted(password)};"),
        })
    if ca_location:
        options["kafka.ssl.truststore.location"] = ca_location
        options["kafka.ssl.truststore.type"] = "PEM"
    return options


def source_options(servers, topic, starting_offsets="earliest", max_per_trigger=None, **login):
    options = {**connection(servers, **login), "subscribe": topic,
               "startingOffsets": starting_offsets}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def sink_options(servers, topic, **login):
    return {**connection(servers, **login), "topic": topic}


def read_messages(spark, options):
    """Unbounded ``(key, value)`` text messages."""
    return (spark.readStream.format("kafka").options(**options).load()
            .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value"))
