"""Reports for people: figures (where matplotlib is installed) and a mail with them. Queries are done in Spark; only small results come here."""

from __future__ import annotations

import smtplib
from datetime import datetime
from email.message import EmailMessage

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_ROWS = 100_000


def _small(df: DataFrame, most: int = REPORT_ROWS):
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows for a figure")
    return rows


def availability_figure(labels: DataFrame, intervals: DataFrame, cutoff: datetime, now: datetime, path: str) -> None:
    """A bar for each station (ord, label), green where it has data (ord, start, end)."""
    import matplotlib

    matplotlib.use("Agg")
    import matplotlib.pyplot as plt

    names, spans = _small(labels.orderBy("ord")), _small(intervals)
    if not len(names):
        raise ValueError("no stations")
    fig, axes = plt.subplots(len(names), 1, figsize=(14, max(2.5, min(1.2 * len(names), 24))), sharex=True, squeeze=False)
    for ax, row in zip(axes[:, 0], names.itertuples(), strict=True):
        ax.axvspan(cutoff, now, color="#ff9999", lw=0)
        for s in spans[spans.ord == row.ord].itertuples():
            ax.axvspan(s.start, s.end, color="#66cc66", lw=0)
        ax.set(xlim=(cutoff, now), ylim=(0, 1), yticks=[])
        ax.text(0.005, 0.8, row.label, transform=ax.transAxes, va="center")
    fig.suptitle(f"Data availability, {now:%Y-%m-%d}")
    fig.savefig(path, dpi=300, bbox_inches="tight")
    plt.close(fig)


def well_observed(df: DataFrame, key: str, value: str, least: int, name: str = "n") -> DataFrame:
    """key and number of values, of keys with more than `least`."""
    return df.groupBy(key).agg(F.count(value).alias(name)).where(F.col(name) > least)


def summary_rows(lvl3: DataFrame, elevation: float = 30, share: float = 0.98, least: int = 300) -> DataFrame:
    """What a satellite's summary shows: masked indices in time order, of satellites with more than `least` values of s4_1."""
    from ..functions.clean import metric_masks

    enough = well_observed(lvl3, "prn", "s4_1", least).select("prn")
    return metric_masks(lvl3, elevation, share).join(enough, "prn", "left_semi").select("prn", "minbin", "elev", "s4_1", "s4_2", "sigma_phi_1", "sigma_phi_2").orderBy("prn", "minbin")


def summary_figure(lvl3: DataFrame, prn: str, path: str, **limits) -> None:
    import matplotlib

    matplotlib.use("Agg")
    import matplotlib.pyplot as plt

    rows = _small(summary_rows(lvl3, **limits).where(F.col("prn") == prn))
    fig, (a, b) = plt.subplots(2, 1, figsize=(12, 7), sharex=True)
    for ax, kind in ((a, "s4"), (b, "sigma_phi")):
        for i in (1, 2):
            ax.plot(rows.minbin, rows[f"{kind}_{i}"], ".", label=f"{kind}_{i}")
        ax.legend()
        ax.twinx().plot(rows.minbin, rows.elev, color="green")
    fig.suptitle(prn)
    fig.savefig(path)
    plt.close(fig)


def status_mail(sender: str, recipients: list[str], subject: str, text: str, figure: bytes | None = None) -> EmailMessage:
    """An HTML mail with the figure inline; it isn't sent."""
    mail = EmailMessage()
    mail["From"], mail["To"], mail["Subject"] = sender, ", ".join(recipients), subject
    mail.set_content(text)
    mail.add_alternative(f"<html><body><p>{text}</p>{'<img src="cid:figure">' if figure else ''}</body></html>", subtype="html")
    if figure:
        mail.get_payload()[1].add_related(figure, "image", "png", cid="<figure>")
        mail.add_attachment(figure, maintype="image", subtype="png", filename="availability.png")
    return mail


def send(mail: EmailMessage, host: str, port: int, user: str, password: str) -> None:
    """Only ever called by the user: nothing in the engine sends mail."""
    with smtplib.SMTP(host, port) as server:
        server.starttls()
        server.login(user, password)
        server.send_message(mail)
