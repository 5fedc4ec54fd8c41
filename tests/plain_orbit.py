"""Plain array code for orbits, one reading at a time, that the plans of skyfilm.operators.orbits are held against."""

from __future__ import annotations

import numpy as np

# fixed values: Earth in kilometres and radians, WGS-72 as used with element sets
MU, RADIUS, J2, FLAT = 398600.8, 6378.135, 1.082616e-3, 1 / 298.26
TURN = 2 * np.pi


def parse_elements(line1: str, line2: str) -> dict[str, float]:
    """Mean elements in radians, revolutions a day, and the epoch as seconds from 1970."""
    year = int(line1[18:20])
    year += 1900 if year >= 57 else 2000
    epoch = np.datetime64(f"{year}-01-01") + np.timedelta64(round((float(line1[20:32]) - 1) * 86400e6), "us")
    deg = np.pi / 180
    return {
        "epoch": epoch.astype("datetime64[us]").astype(np.int64) / 1e6,
        "drag": float(line1[33:43].replace(" ", "") or 0),
        "incl": float(line2[8:16]) * deg,
        "node": float(line2[17:25]) * deg,
        "ecc": float("0." + line2[26:33].strip()),
        "peri": float(line2[34:42]) * deg,
        "anom": float(line2[43:51]) * deg,
        "motion": float(line2[52:63]),
    }


def sidereal(seconds: np.ndarray) -> np.ndarray:
    """Greenwich mean sidereal angle."""
    d = seconds / 86400 + 2440587.5 - 2451545.0
    return np.deg2rad((280.46061837 + 360.98564736629 * d) % 360)


def position(e: dict, seconds: np.ndarray) -> np.ndarray:
    """Inertial (x, y, z) in kilometres."""
    n = e["motion"] * TURN / 86400
    dt = np.asarray(seconds, dtype=float) - e["epoch"]
    a = (MU / n**2) ** (1 / 3)
    ratio = J2 * (RADIUS / (a * (1 - e["ecc"] ** 2))) ** 2
    node = e["node"] - 1.5 * n * ratio * np.cos(e["incl"]) * dt
    peri = e["peri"] + 0.75 * n * ratio * (5 * np.cos(e["incl"]) ** 2 - 1) * dt
    mean = e["anom"] + n * dt + e["drag"] * TURN * (dt / 86400) ** 2
    mean += 0.75 * n * ratio * np.sqrt(1 - e["ecc"] ** 2) * (3 * np.cos(e["incl"]) ** 2 - 1) * dt
    ecc = mean.copy()
    for _ in range(8):
        ecc = ecc - (ecc - e["ecc"] * np.sin(ecc) - mean) / (1 - e["ecc"] * np.cos(ecc))
    x, y = a * (np.cos(ecc) - e["ecc"]), a * np.sqrt(1 - e["ecc"] ** 2) * np.sin(ecc)
    cp, sp, cn, sn, ci, si = np.cos(peri), np.sin(peri), np.cos(node), np.sin(node), np.cos(e["incl"]), np.sin(e["incl"])
    return np.stack([x * (cp * cn - sp * sn * ci) - y * (sp * cn + cp * sn * ci), x * (cp * sn + sp * cn * ci) - y * (sp * sn - cp * cn * ci), x * sp * si + y * cp * si], axis=-1)


def ground_point(xyz: np.ndarray, seconds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Latitude and longitude in degrees and height in kilometres under an inertial position."""
    lon = (np.arctan2(xyz[..., 1], xyz[..., 0]) - sidereal(seconds) + np.pi) % TURN - np.pi
    r, e2 = np.hypot(xyz[..., 0], xyz[..., 1]), FLAT * (2 - FLAT)
    lat = np.arctan2(xyz[..., 2], r)
    for _ in range(6):
        c = RADIUS / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        lat = np.arctan2(xyz[..., 2] + c * e2 * np.sin(lat), r)
    height = r * np.cos(lat) + xyz[..., 2] * np.sin(lat) - RADIUS * np.sqrt(1 - e2 * np.sin(lat) ** 2)
    return np.rad2deg(lat), np.rad2deg(lon), height


def seen_from(xyz: np.ndarray, seconds: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Altitude in degrees and distance in kilometres above a station's horizon."""
    la, th = np.deg2rad(lat), np.deg2rad(lon) + sidereal(seconds)
    e2 = FLAT * (2 - FLAT)
    c = RADIUS / np.sqrt(1 - e2 * np.sin(la) ** 2)
    station = np.stack([c * np.cos(la) * np.cos(th), c * np.cos(la) * np.sin(th), c * (1 - e2) * np.sin(la)], axis=-1)
    d = xyz - station
    far = np.linalg.norm(d, axis=-1)
    up = np.stack([np.cos(la) * np.cos(th), np.cos(la) * np.sin(th), np.sin(la) + 0 * th], axis=-1)
    return np.rad2deg(np.arcsin(np.clip((d * up).sum(axis=-1) / far, -1, 1))), far


# fixed values: the window, in days around a reading, that its time quality asks to search; others are not searched
WINDOWS = {1: (-0.010416, 0.010416), 3: (0.0, 0.041667), 4: (0.0, 1.0)}


def passes(e: dict, begin: float, end: float, lat: float, lon: float, least: float = 15.0, step: float = 60.0) -> list[tuple[str, float]]:
    """(event, seconds): rise, culminate and set at an altitude, found on a grid and halved down to a second."""
    t = np.arange(begin, end + step, step)

    def altitude(s):
        s = np.atleast_1d(np.asarray(s, dtype=float))
        return seen_from(position(e, s), s, np.full(len(s), lat), np.full(len(s), lon))[0]

    alt, out = altitude(t), []
    for i in range(len(t) - 1):
        if (alt[i] < least) != (alt[i + 1] < least):
            a, b, rising = t[i], t[i + 1], alt[i] < least
            while b - a > 1:
                m = (a + b) / 2
                a, b = (m, b) if (altitude(m)[0] < least) == rising else (a, m)
            out.append(("rise" if rising else "set", float(a)))
    top = np.flatnonzero((alt[1:-1] > alt[:-2]) & (alt[1:-1] >= alt[2:]) & (alt[1:-1] >= least)) + 1
    return sorted(out + [("culminate", float(t[i])) for i in top], key=lambda x: x[1])
