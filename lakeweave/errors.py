"""Errors of the engine, their categories, and which of them are worth a retry."""

from __future__ import annotations

import enum
import logging
import re
from collections.abc import Mapping

log = logging.getLogger("lakeweave")


class ErrorCategory(enum.Enum):
    TRANSIENT = "transient"
    AUTH = "authentication"
    CLIENT = "client"
    SERVER = "server"
    CONFIG = "configuration"


class LakeError(Exception):
    """Base of the engine's errors."""

    category = ErrorCategory.CLIENT
    retryable = False
    hint = ""


class CastingError(LakeError, ValueError):
    """A value or type can't be cast to the table's schema."""

    hint = "Compare the batch's types with the table's; strict_casting=False lets casts that lose nothing pass."


class SchemaEvolutionError(LakeError, ValueError):
    """A batch's schema can't be reached from the table's by safe changes."""

    hint = "Safe changes are new columns, int to long, float to double and wider decimals."


class UndefinedTableError(LakeError, KeyError):
    """The table has no metadata."""

    hint = "Load something into the table first, or check namespace and name."

    def __str__(self) -> str:
        return str(self.args[0]) if self.args else ""


class ValidationError(LakeError, ValueError):
    """An option or a table's declaration is wrong."""


class ConfigError(LakeError, ValueError):
    category = ErrorCategory.CONFIG
    hint = "Check the warehouse configuration."


class CommitConflictError(LakeError):
    """Another writer committed the same version first."""

    category, retryable = ErrorCategory.TRANSIENT, True
    hint = "The commit is tried again on the newest version."


class CommitStateUnknownError(LakeError):
    category, retryable = ErrorCategory.TRANSIENT, True
    hint = "Whether the commit took place is read back before it is tried again."


class StorageUnavailableError(LakeError):
    category, retryable = ErrorCategory.SERVER, True
    hint = "The file system did not answer; try again later."


class AuthError(LakeError):
    category = ErrorCategory.AUTH
    hint = "Check the storage credentials."


class AuthExpiredError(AuthError):
    """An authorisation ran out; the next attempt asks for a new one."""

    retryable = True


#: Error classes of the runtime -> (category, retryable); looked up along the class's bases.
KNOWN: dict[type[BaseException], tuple[ErrorCategory, bool]] = {
    ConnectionError: (ErrorCategory.TRANSIENT, True),
    TimeoutError: (ErrorCategory.TRANSIENT, True),
    PermissionError: (ErrorCategory.AUTH, False),
    FileNotFoundError: (ErrorCategory.CLIENT, False),
    FileExistsError: (ErrorCategory.TRANSIENT, True),
    OSError: (ErrorCategory.SERVER, True),
    KeyError: (ErrorCategory.CLIENT, False),
    ValueError: (ErrorCategory.CLIENT, False),
    TypeError: (ErrorCategory.CLIENT, False),
}


def _known(error: BaseException) -> tuple[ErrorCategory, bool] | None:
    if isinstance(error, LakeError):
        return error.category, error.retryable
    return next((KNOWN[c] for c in type(error).__mro__ if c in KNOWN), None)


def is_retryable(error: BaseException) -> bool:
    """Subclasses count as their bases; unknown errors aren't retried."""
    found = _known(error)
    return bool(found and found[1])


def category_of(error: BaseException) -> ErrorCategory | None:
    found = _known(error)
    return found[0] if found else None


def friendly_message(error: BaseException, operation: str) -> str:
    hint = error.hint if isinstance(error, LakeError) else ""
    return f"{operation} failed ({type(error).__name__}): {error}" + (f" {hint}" if hint else "")


def log_error(error: BaseException, operation: str, table: str | None = None, attempt: int | None = None, attempts: int | None = None, **context) -> None:
    found = category_of(error)
    parts = {"operation": operation, "table": table, "attempt": f"{attempt}/{attempts}" if attempt else None, "error": type(error).__name__, "category": found.value if found else "unknown", "retryable": is_retryable(error), **context}
    log.log(logging.WARNING if is_retryable(error) else logging.ERROR, "%s: %s", ", ".join(f"{k}={v}" for k, v in parts.items() if v is not None), error)


#: JVM classes (by name, matched along causes and bases) -> what is raised for them.
JVM: Mapping[str, type[Exception]] = {
    "org.apache.hadoop.security.token.SecretManager$InvalidToken": AuthExpiredError,
    "org.apache.hadoop.security.AccessControlException": AuthError,
    "java.nio.file.AccessDeniedException": AuthError,
    "javax.security.sasl.SaslException": AuthError,
    "java.io.FileNotFoundException": FileNotFoundError,
    "java.nio.file.NoSuchFileException": FileNotFoundError,
    "org.apache.hadoop.fs.FileAlreadyExistsException": CommitConflictError,
    "java.nio.file.FileAlreadyExistsException": CommitConflictError,
    "java.net.SocketTimeoutException": StorageUnavailableError,
    "java.net.ConnectException": StorageUnavailableError,
    "java.net.UnknownHostException": StorageUnavailableError,
    "java.io.InterruptedIOException": StorageUnavailableError,
    "java.io.IOException": StorageUnavailableError,
}


def _jvm_error(error: BaseException) -> Exception | None:
    """This engine's error for an exception of the JVM: that of the first class known, from the exception over its bases to its causes."""
    thrown, text = getattr(error, "java_exception", None), str(error)
    for _ in range(10):
        if thrown is None:
            return None
        kind = thrown.getClass()
        while kind is not None:
            if (found := JVM.get(kind.getName())) is not None:
                said = thrown.getMessage() or text.split("\n", 1)[0]
                if found is StorageUnavailableError and re.search(r"\b(401|expired|ExpiredToken)\b", said):
                    return AuthExpiredError(said)
                if found is StorageUnavailableError and re.search(r"\b(403|AccessDenied|Forbidden)\b", said):
                    return AuthError(said)
                return found(said)
            kind = kind.getSuperclass()
        thrown = thrown.getCause()
    return None


def translate(error: Exception) -> Exception:
    """The engine's own error for a failed Spark job or call to the JVM, where there is one."""
    text = str(error)
    for mark, kind in (("LAKEWEAVE_CAST:", CastingError), ("LAKEWEAVE_REQUIRED:", CastingError)):
        if mark in text:
            return kind(text.split(mark, 1)[1].split("\n", 1)[0].strip().rstrip('"'))
    if any(x in text for x in ("CAST_OVERFLOW", "CAST_INVALID_INPUT", "NUMERIC_VALUE_OUT_OF_RANGE", "ARITHMETIC_OVERFLOW")):
        return CastingError(text.split("\n", 1)[0])
    return _jvm_error(error) or error
